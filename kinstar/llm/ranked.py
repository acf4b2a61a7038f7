"""Exact ranked lexical search with hashed max-sketches.

Terms are runs of ASCII letters and digits (capitals lowered) and of characters beyond
ASCII. With N documents that hold a term, L terms in all, n in a document, df documents
that hold a term and tf occurrences in one, a term weighs
floor(1000 ln((2N + 2) / (2 df + 1))), its impact on a document is
(10^9 tf) div (1000 tf + 8 m) with m = 10 + (90 n N) div L, and a document's score is the
sum of weight times impact over the query's terms.

*Statistics.* One pass counts N, L and the df of the queries' terms, added up in every
task before the shuffle.

*Sketches.* A document's impacts are folded by a hash of the term into coordinates, of
which each keeps the largest impact. A document has 8 to 16 times as many coordinates as
terms (a power of two), and documents of one width form a matrix. What a
query's terms find there, times their weights, adds up to an upper bound of the score
for all documents of the matrix at once.

*Rescoring.* In each block of documents and for each query, documents are scored exactly
from their own terms in descending order of bound, until the bound is below the k-th best
exact score; that score is carried on to the task's next blocks. Each task gives k
documents per query at most, of which Spark keeps the k best (limited per partition
before the shuffle, too).

Queries are taken in blocks of ``QUERIES`` texts and ``TERMS`` terms: a block's terms and
weights, of bounded size, go to every task, and the documents are read once per block and
once for the statistics of all. A query with more terms than that is a block of its own.

Defined cases: null and blank texts have no terms; such queries find nothing; scores
of 0 are not returned; rows with a null id count in the statistics but are not
returned; rows that repeat an id are found each, and a repeated item id is asked once,
with its smallest text; equal scores go by ascending id; texts are read whole, a long
document is a matrix of its own; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinstar.llm.words import BARE, Words, blocks, split_words

#: Queries, and terms of them, in one pass over the documents.
QUERIES, TERMS = 4096, 1 << 20
#: Documents scored at once, before the bound is compared again.
CHUNK = 32
#: A document has 2**SPARE to 2**(SPARE + 1) coordinates per term.
SPARE = 3
#: Numbers of a matrix of sketches at most, unless one document has more coordinates.
MATRIX = 1 << 20


def document_terms(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term hash, occurrences) of every distinct term, by document, then hash."""
    document = np.repeat(np.arange(len(words)), np.diff(words.first))
    order = np.lexsort((words.hashes, document))
    document, terms = document[order], words.hashes[order]
    new = np.ones(len(terms), dtype=bool)
    new[1:] = (document[1:] != document[:-1]) | (terms[1:] != terms[:-1])
    at = np.flatnonzero(new)
    return document[at], terms[at], np.diff(np.append(at, len(terms)))


def text_terms(text: str | None) -> np.ndarray:
    """The distinct terms of one text, as hashes."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), dtype=np.uint8)
    return np.unique(split_words(data, np.array([0, len(data)]), lower=True, space=BARE).hashes)


def query_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """(ids, terms of each) of the queries, in blocks of bounded size."""
    once = items.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.min(F.col(text_col).cast("string")).alias("text"))
    ids, terms, size = [], [], 0
    for row in once.toLocalIterator():
        own = text_terms(row["text"])
        if ids and (len(ids) >= QUERIES or size + len(own) > TERMS):
            yield np.array(ids, dtype=np.int64), terms
            ids, terms, size = [], [], 0
        ids.append(row["id"])
        terms.append(own)
        size += len(own)
    if ids:
        yield np.array(ids, dtype=np.int64), terms


def corpus_counts(docs: DataFrame, vocabulary: np.ndarray, text_col: str) -> tuple[int, int, np.ndarray]:
    """(documents with a term, terms in all, documents that hold each term of the sorted ``vocabulary``)."""
    def run(batches):
        held, length, count = 0, 0, np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            for _, _, words in blocks(batch.column(0), lower=True, space=BARE):
                held += int((np.diff(words.first) > 0).sum())
                length += len(words.hashes)
                if len(vocabulary):
                    place = np.searchsorted(vocabulary, words.hashes).clip(max=len(vocabulary) - 1)
                    known = vocabulary[place] == words.hashes
                    document = np.repeat(np.arange(len(words)), np.diff(words.first))[known]
                    pairs = np.unique(document * len(vocabulary) + place[known])
                    count += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, [-1, -2])), pa.array(np.append(count[at], [held, length]))],
                                         names=["term", "n"])

    out = np.zeros(len(vocabulary) + 2, dtype=np.int64)  # the last two: places -2 and -1
    counted = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "term long, n long")
    for row in counted.groupBy("term").agg(F.sum("n").alias("n")).collect():  # a row per term of the vocabulary
        out[row["term"]] = row["n"]
    return int(out[-1]), int(out[-2]), out[:-2]


def term_weights(held: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * held + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)


def _length_parts(lengths: np.ndarray, held: int, length: int) -> np.ndarray:
    """m of documents with so many terms."""
    if 90 * int(lengths.max(initial=0)) * held < 2 ** 62:
        return 10 + 90 * lengths * held // max(1, length)
    return np.array([10 + 90 * n * held // max(1, length) for n in lengths.tolist()], dtype=np.int64)


class Asked:
    """One block of queries: the sorted vocabulary, and each query's places in it with their weights."""

    def __init__(self, ids: np.ndarray, terms: list[np.ndarray], vocabulary: np.ndarray, weights: np.ndarray):
        self.ids = ids
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *terms]))
        self.places = [np.searchsorted(self.vocabulary, t) for t in terms]
        self.weight = weights[np.searchsorted(vocabulary, self.vocabulary)]


class Block:
    """A block of documents: exact impacts of the terms that some query has, and the sketches of all terms."""

    def __init__(self, words: Words, asked: Asked, held: int, length: int):
        document, terms, tf = document_terms(words)
        n = np.diff(words.first)
        impacts = 1_000_000_000 * tf // (1000 * tf + 8 * _length_parts(n, held, length)[document])
        # exact: the documents' terms that are asked for
        v = asked.vocabulary
        place = np.searchsorted(v, terms).clip(max=max(0, len(v) - 1))
        known = v[place] == terms if len(v) else np.zeros(len(terms), dtype=bool)
        self.place, self.impact = place[known], impacts[known]
        self.first = np.searchsorted(document[known], np.arange(len(words) + 1))
        # sketches: matrices (coordinates, documents) of documents of one width
        first = np.searchsorted(document, np.arange(len(words) + 1))
        distinct = np.diff(first)
        bits = np.frexp(np.maximum(1, distinct))[1] + SPARE
        self.matrices: list[tuple[np.ndarray, np.ndarray, int]] = []
        for b in np.unique(bits[distinct > 0]).tolist():
            own = np.flatnonzero((bits == b) & (distinct > 0))
            for a in range(0, len(own), max(1, MATRIX >> b)):
                rows = own[a:a + max(1, MATRIX >> b)]
                size = distinct[rows]
                at = np.repeat(first[rows] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                sketch = np.zeros((1 << b, len(rows)), dtype=np.float32)  # impacts are below 2**24, so exact
                np.maximum.at(sketch, (_coordinates(terms[at], b), np.repeat(np.arange(len(rows)), size)), impacts[at])
                self.matrices.append((rows, sketch, b))

    def bounds(self, terms: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, upper bounds of their scores for one query)."""
        found = [(rows, weight @ sketch[_coordinates(terms, b)]) for rows, sketch, b in self.matrices]
        # a little more than the sums, whose rounding must not decide
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]) * (1 + 1e-9)

    def exact(self, documents: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        """Scores, with ``weight_of`` 0 for the terms that the query doesn't have."""
        first, size = self.first[documents], self.first[documents + 1] - self.first[documents]
        at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        run = np.concatenate(([0], np.cumsum(weight_of[self.place[at]] * self.impact[at])))
        ends = np.cumsum(size)
        return run[ends] - run[ends - size]


def _coordinates(terms: np.ndarray, bits: int) -> np.ndarray:
    return (terms >> np.uint64(64 - bits)).astype(np.int64)


class Best:
    """The k best (score, id) of one query so far."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def least(self) -> int:
        """A document with a bound below this cannot be among the k best."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        may = scores >= self.least()
        scores, ids = np.append(self.scores, scores[may]), np.append(self.ids, ids[may])
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]


def search_block(block: Block, ids: np.ndarray, asked: Asked, best: list[Best]) -> int:
    """Add a block's documents to each query's k best; the number of documents scored exactly."""
    scored = 0
    if not block.matrices:
        return scored
    weight_of = np.zeros(len(asked.vocabulary), dtype=np.int64)
    for places, found in zip(asked.places, best):
        weight = asked.weight[places]
        documents, bounds = block.bounds(asked.vocabulary[places], weight.astype(np.float64))
        may = np.flatnonzero(bounds >= found.least())
        order = may[np.argsort(-bounds[may], kind="stable")]
        weight_of[places] = weight
        for a in range(0, len(order), CHUNK):
            chunk = order[a:a + CHUNK]
            if bounds[chunk[0]] < found.least():
                break
            found.add(block.exact(documents[chunk], weight_of), ids[documents[chunk]])
            scored += len(chunk)
        weight_of[places] = 0
    return scored


def _searched(asked: Asked, held: int, length: int, k: int):
    def run(batches):
        best = [Best(k) for _ in asked.ids]
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for a, b, words in blocks(batch.column(1), lower=True, space=BARE):
                search_block(Block(words, asked, held, length), ids[a:b], asked, best)
        for a in range(0, len(best), 1024):
            part = best[a:a + 1024]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(asked.ids[a:a + 1024], [len(x.ids) for x in part])),
                 pa.array(np.concatenate([x.ids for x in part])), pa.array(np.concatenate([x.scores for x in part]))],
                names=["item_id", "doc_id", "score"])
    return run


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each query's k documents of the highest scores above 0."""
    spark = docs.sparkSession
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for ids, terms in query_blocks(items, item_col, item_text):
        vocabulary = np.unique(np.concatenate(terms))
        held, length, df = corpus_counts(docs, vocabulary, text_col)
        asked = Asked(ids, terms, vocabulary, term_weights(held, df))
        found = found.unionByName(rows.mapInArrow(_searched(asked, held, length, k), found.schema))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.col("item_id").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score")
