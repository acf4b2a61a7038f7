"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

*Features*: which words (runs of letters and digits, lower case) and beginnings of
words (their first 4, 5 and 6 bytes, which carries over to other endings) occur
in the whole text, by their 64-bit hashes, among those that at least ``MIN_DOCS``
training documents hold and that occur unequally often in toxic and other ones
(chi-square of at least ``CHI``).

*Grades*: the labels only say whether a document is toxic, so grade 0 is "not
toxic", and toxic training documents are graded 1 to ``GRADES - 1`` by how many of
their features tell toxic from other documents (log-odds over the training
documents), in equal parts.

*Model*: one weight per word, shared by all grades, and ordered thresholds:
P(grade <= j) = logistic(threshold_j - weights . x). It is fitted with Adam on
at most ``SAMPLE`` labelled documents of either kind, those with the smallest
hashes of their ids; that bound is the size of all that the driver holds.

*Result*: expected severity (the mean grade), P(toxic) = P(grade >= 1), the most
likely grade, and the decision P(toxic) >= 0.5.

Defined cases: null and empty texts have no features; label rows without an id
or a label are ignored, of several labels of a document the largest counts; with
no toxic (or no other) training documents nothing is fitted and every document
gets severity 0; a null document id stays null; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinstar.llm.words import BARE, Words, blocks, prefix_hashes

GRADES = 4
#: Training documents of either kind at most; documents a word must occur in.
SAMPLE, MIN_DOCS = 1500, 5
#: Least chi-square (one degree of freedom) of a word's occurrence by toxicity: p < 1e-6.
CHI = 25.0
#: Bytes of the beginnings of words.
PREFIXES = (4, 5, 6)
_EPOCHS, _RATE, _PENALTY = 400, 0.1, 1e-3


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """Sorted word hashes, their weights, and the thresholds between grades."""

    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, doc: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
        """weights . x of n documents, given (document, word hash) pairs."""
        if not len(self.words):
            return np.zeros(n)
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        hit = self.words[at] == hashes
        pairs = np.unique(doc[hit] * len(self.words) + at[hit])
        return np.bincount(pairs // len(self.words), self.weights[pairs % len(self.words)], minlength=n)

    def grades(self, scores: np.ndarray) -> np.ndarray:
        """P(grade = j) per document."""
        below = _logistic(self.thresholds[None, :] - scores[:, None])
        below = np.concatenate([np.zeros((len(scores), 1)), below, np.ones((len(scores), 1))], axis=1)
        return np.diff(below, axis=1)


def grade(docs: list[np.ndarray], toxic: np.ndarray, grades: int) -> np.ndarray:
    """Training grades: 0, or by how many features are marks of toxic documents."""
    held = np.concatenate([np.zeros(0, dtype=np.uint64), *docs])
    vocabulary, word = np.unique(held, return_inverse=True)
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    of_toxic = np.bincount(word, toxic[owner].astype(float), minlength=len(vocabulary))
    of_rest = np.bincount(word, (~toxic[owner]).astype(float), minlength=len(vocabulary))
    odds = np.log((of_toxic + 0.5) / (toxic.sum() + 1)) - np.log((of_rest + 0.5) / ((~toxic).sum() + 1))
    marks = (odds > 2) & (of_toxic >= MIN_DOCS)
    held = np.bincount(owner, marks[word].astype(float), minlength=len(docs))
    out = np.zeros(len(docs), dtype=np.int64)
    own = np.flatnonzero(toxic)
    rank = np.argsort(np.argsort(held[own], kind="stable"), kind="stable")
    out[own] = 1 + rank * (grades - 1) // max(1, len(own))
    return out


def fit_ordinal(docs: list[np.ndarray], y: np.ndarray, grades: int) -> Model:
    """Fit weights and ordered thresholds to documents (distinct word hashes) of given grades."""
    held = np.concatenate([np.zeros(0, dtype=np.uint64), *docs])
    vocabulary, word, count = np.unique(held, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    share = (y > 0).mean()
    extra = np.bincount(word, (y[owner] > 0).astype(float), minlength=len(vocabulary)) - share * count
    chance = share * (1 - share) * count * (1 - count / len(docs))
    used = (count >= MIN_DOCS) & (extra ** 2 >= CHI * np.maximum(chance, 1e-9))
    column = np.cumsum(used) - 1
    keep = used[word]
    rows, cols = owner[keep], column[word[keep]]
    n, v = len(docs), int(used.sum())
    w = np.zeros(v)
    # thresholds = first + running sums of exp(gaps), which keeps them ordered
    t = np.concatenate([[0.0], np.zeros(grades - 2)])
    params = [w, t]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    every = np.arange(n)
    for step in range(1, _EPOCHS + 1):
        s = np.bincount(rows, w[cols], minlength=n)
        theta = t[0] + np.concatenate([[0.0], np.cumsum(np.exp(t[1:]))])
        f = _logistic(theta[None, :] - s[:, None])
        f = np.concatenate([np.zeros((n, 1)), f, np.ones((n, 1))], axis=1)
        hi, lo = f[every, y + 1], f[every, y]
        p = np.maximum(hi - lo, 1e-12)
        g_s = (1 - hi - lo) / n  # of the negative log-likelihood
        g_w = np.bincount(cols, g_s[rows], minlength=v) + _PENALTY * w / max(1, np.sqrt(v))
        d_hi, d_lo = -hi * (1 - hi) / p / n, lo * (1 - lo) / p / n
        g_theta = np.zeros(grades + 1)
        np.add.at(g_theta, y + 1, d_hi)
        np.add.at(g_theta, y, d_lo)
        g_theta = g_theta[1:grades]
        tail = np.cumsum(g_theta[::-1])[::-1]
        g_t = np.concatenate([[tail[0]], tail[1:] * np.exp(t[1:])])
        for p_, g, (m1, m2) in zip(params, (g_w, g_t), moments):
            m1 += 0.1 * (g - m1)
            m2 += 0.001 * (g * g - m2)
            p_ -= _RATE * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-9)
    theta = t[0] + np.concatenate([[0.0], np.cumsum(np.exp(t[1:]))])
    return Model(vocabulary[used], w, theta)


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature hash) of all words and beginnings of words of a block."""
    owner = np.repeat(np.arange(len(words)), np.diff(words.first))
    parts = [(owner, words.hashes)]
    for size in PREFIXES:
        longer, hashes = prefix_hashes(words, size, lower=True)
        parts.append((owner[longer], hashes))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def distinct_features(words: Words) -> list[np.ndarray]:
    """Sorted distinct feature hashes of each document of a block."""
    doc, hashes = features(words)
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    doc, hashes = doc[new], hashes[new]
    return np.split(hashes, np.searchsorted(doc, np.arange(1, len(words))))


def _distinct(batches):
    """(id, packed distinct features) of each text."""
    for batch in batches:
        for row, end, words in blocks(batch.column(1), lower=True, space=BARE):
            packed = [h.tobytes() for h in distinct_features(words)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), pa.array(packed, pa.binary())],
                                             names=["id", "words"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE, grades: int = GRADES) -> Model:
    """Fit on at most ``sample`` labelled documents of either kind."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).cast("long").alias("id")).agg((F.max(label_col) > 0).alias("toxic")))
    known = known.join(texts.where("id is not null").select("id").distinct(), "id", "left_semi")
    chosen = None
    for kind in (True, False):
        part = known.where(F.col("toxic") == kind).orderBy(F.xxhash64("id"), "id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    # bounded by 2 * sample rows
    rows = (texts.join(F.broadcast(chosen), "id").select("id", "text").mapInArrow(_distinct, "id long, words binary")
            .join(F.broadcast(chosen), "id").collect())
    rows = sorted({r["id"]: r for r in sorted(rows, key=lambda r: (r["id"], r["words"]))}.values(), key=lambda r: r["id"])
    toxic = np.array([r["toxic"] for r in rows], dtype=bool)
    if not toxic.any() or toxic.all():
        return Model(np.zeros(0, dtype=np.uint64), np.zeros(0), np.full(grades - 1, 40.0))
    held = [np.frombuffer(r["words"], dtype=np.uint64) for r in rows]
    return fit_ordinal(held, grade(held, toxic, grades), grades)


def severity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with expected_severity, p_toxic, grade and is_toxic added."""
    schema = (T.StructType().add("expected_severity", "double").add("p_toxic", "double")
              .add("grade", "integer").add("is_toxic", "boolean"))
    added = schema.names
    kept = [c for c in docs.columns if c not in added]
    place = kept.index(text_col)

    def run(batches):
        levels = np.arange(len(model.thresholds) + 1)
        for batch in batches:
            parts = []
            text = batch.column(place)
            for row, end, words in blocks(text, lower=True, space=BARE):
                n = end - row
                s = model.scores(*features(words), n)
                parts.append(model.grades(s))
            p = np.concatenate(parts) if parts else np.zeros((0, len(levels)))
            toxic = 1 - p[:, 0]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p @ levels), pa.array(toxic), pa.array(p.argmax(axis=1).astype(np.int32)),
                 pa.array(toxic >= 0.5)], names=[*kept, *added])

    source = docs.select(*kept)
    return source.mapInArrow(run, T.StructType(source.schema.fields + schema.fields))


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, as they are: a filter while
    reading, whatever their columns are called."""
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            keep = [model.grades(model.scores(*features(words), end - row))[:, 0] > 0.5
                    for row, end, words in blocks(batch.column(place), lower=True, space=BARE)]
            yield batch.filter(pa.array(np.concatenate(keep) if keep else np.zeros(0, dtype=bool)))

    return docs.mapInArrow(run, docs.schema)
