"""Scores of documents by a gated recurrent language model, and by a unigram model.

Tokens are words (runs of characters other than white space, capitals lowered) and one
end per document, which counts as a token. Rows whose id's text has a CRC-32 of
remainder 2 modulo 7 are held out; all others are learned from.

* Every word of all training documents is counted exactly (added up in every task, then
  by a shuffle); N tokens, V different ones.
* Base: the sum over tokens of log10((c + 1) / (N + V + 1)).
* Model: the ``WORDS`` most frequent tokens are the words of the recurrent network
  (``gru.py``). All others fall into ``TAILS`` tail classes by their last two bytes. The
  network gives a tail class its probability at each place, and a word within it has
  (c + 1) / (N_k + V_k + 1), with the counts of all training tokens of the class, so
  that the probabilities of known words and one unknown word of a class add up to 1.

The output's biases start from the counts of the whole corpus; the network's weights are
fitted on every token of all training documents, cut into pieces of ``PIECE`` tokens that
are dealt into shards of about ``SHARD`` tokens by their hashes, however Spark deals the
rows. A first shard sets out; the others follow in ``ROUNDS`` rounds: the shards of a round
are fitted side by side, a task each, from the mean of the models of the round before.
Whole documents are scored, with the state carried from window to window.

Counts of the most frequent words, at most ``FREQUENT``, go to every task. The other words of a
document are joined with the counts by a shuffle: one row per document and different
rare word, whose words are none of the frequent ones, so that no key is hot unless it
occurs in held-out rows alone, which Spark splits (nothing is aggregated between the
exchange and the join).

Defined cases: null and blank texts are the end alone; rows with a null id are learned
from and scored as rows of their own; repeated rows count each; without training rows
every count is 0 and the score is the base score; texts are whole, however long; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinstar.llm.graph import drop_stored, stored
from kinstar.llm.gru import EPOCHS, RATE, TRAIN_LANES, Gru
from kinstar.llm.words import Words, blocks, mix64

#: Words of the network, classes of its words, tail classes, counts that every task gets.
WORDS, CLASSES, TAILS, FREQUENT = 2048, 32, 32, 1 << 16
#: Training: tokens of a piece and of a shard, rounds after the first shard, lanes there, models averaged at once.
PIECE, SHARD, ROUNDS, SIDE, MERGED = 512, 1 << 19, 3, 256, 8
MAX_TASKS = 50_000
#: Different words that a task counts before it passes them on.
_HELD = 1 << 20
#: Tokens scored side by side.
_TOKENS = 1 << 22
#: Upper bits of a hash by which a word is looked up.
_UPPER = 17
END = int(mix64(np.array([0x656E64], dtype=np.uint64)).astype(np.int64)[0])

_LOWER = np.arange(256, dtype=np.int64)
_LOWER[65:91] += 32


def _upper(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> (64 - _UPPER)) + (1 << (_UPPER - 1))


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("")).cast("binary")) % 7 == 2


def tokens(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, tail classes, tokens per document) with each document's end."""
    n = np.diff(words.first)
    document = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(words.hashes)) + document
    hashes = np.full(len(words.hashes) + len(n), END, dtype=np.int64)
    hashes[place] = words.hashes.view(np.int64)
    tails = np.zeros(len(hashes), dtype=np.int8)
    if len(words.hashes):
        last = _LOWER[words.data[words.ends - 1]]
        second = np.where(words.ends - words.starts > 1, _LOWER[words.data[np.maximum(words.ends - 2, 0)]], 0)
        tails[place] = (last * 37 + second * 11) % TAILS
    return hashes, tails, n + 1


def _merged(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    hashes, tails, n = (np.concatenate(p) for p in zip(*parts))
    order = np.argsort(hashes)  # in any order among equal ones, which are the same word
    hashes = hashes[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = hashes[1:] != hashes[:-1]
    first = np.flatnonzero(new)
    return hashes[first], tails[order[first]], np.add.reduceat(n[order], first)


def word_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """(h, tail, n) of every different token."""
    names = ["h", "tail", "n"]

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            for _, _, words in blocks(batch.column(0), lower=True):
                hashes, tails, _ = tokens(words)
                parts.append(_merged([(hashes, tails, np.ones(len(hashes), dtype=np.int64))]))
                size += len(parts[-1][0])
                if size > _HELD:
                    parts = [_merged(parts)]
                    size = len(parts[0][0])
                    if size > _HELD // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in parts[0]], names=names)
                        parts, size = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _merged(parts)], names=names)

    found = texts.select(F.col(text_col).cast("string")).mapInArrow(run, "h long, tail byte, n long")
    return found.groupBy("h", "tail").agg(F.sum("n").alias("n"))


class Lexicon:
    """The frequent words, by hash, and the symbols of the network."""

    def __init__(self, rows: list[tuple[int, int, int]], of_tails: dict[int, tuple[int, int]]):
        """``rows``: (hash, tail, count), the most frequent first; ``of_tails``: (tokens, different ones) of all words."""
        hashes, tails, counts = (np.array(c, dtype=np.int64) for c in zip(*rows))
        words = min(WORDS, len(rows))
        # classes of about equal weight, by the square roots of the counts
        share = np.cumsum(np.sqrt(counts[:words]))
        edges = np.searchsorted(share, share[-1] * np.arange(1, CLASSES) / CLASSES)
        self.edges = np.unique(np.concatenate(([0], edges, [words])))
        self.n_tail, self.v_tail = np.zeros(TAILS, dtype=np.int64), np.zeros(TAILS, dtype=np.int64)
        for tail, (n, v) in of_tails.items():
            self.n_tail[tail], self.v_tail[tail] = n, v
        np.subtract.at(self.n_tail, tails[:words], counts[:words])
        np.subtract.at(self.v_tail, tails[:words], np.minimum(counts[:words], 1))
        self.symbol_counts = np.concatenate([counts[:words], self.n_tail])
        self.words, order = words, np.argsort(hashes)
        self.hashes, self.counts, self.rank = hashes[order], counts[order], order
        # where the words begin whose hashes have the same upper bits, and how many those are at most
        upper = _upper(self.hashes)
        self.start = np.searchsorted(upper, np.arange(1 << _UPPER)).astype(np.int32)
        self.most = int(np.bincount(upper).max())
        where = int(np.searchsorted(self.hashes, END))
        known = where < len(order) and self.hashes[where] == END and self.rank[where] < words
        self.begin = int(self.rank[where]) if known else words

    def look_up(self, hashes: np.ndarray, tails: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, counts; -1 for a word that is not frequent)."""
        at, last = self.start[_upper(hashes)], len(self.hashes) - 1
        np.minimum(at, last, out=at)
        for _ in range(self.most):  # a binary search in all of them takes three times as long
            at += self.hashes[at] < hashes
            np.minimum(at, last, out=at)
        known = self.hashes[at] == hashes
        symbols = np.where(known & (self.rank[at] < self.words), self.rank[at], self.words + tails.astype(np.int64))
        return symbols, np.where(known, self.counts[at], -1)


def _frequent(words: DataFrame) -> list[tuple[int, int, int]]:
    """(hash, tail, count) of at most FREQUENT words, the most frequent first.

    Words are counted by steps of their logarithm of count, and those above the step at which
    they would be too many are fetched, so the driver never gets more than that."""
    step = F.floor(32 * F.log2("n")).cast("int")
    sizes = sorted(((r["step"], r["m"]) for r in words.groupBy(step.alias("step")).agg(F.count("*").alias("m")).collect()), reverse=True)
    least, total = None, 0
    for k, m in sizes:
        total += m
        if total > FREQUENT:
            break
        least = k
    # words that are all equally rare: those of the smallest hashes
    chosen = words.where(step >= least) if least is not None else words.where(step == sizes[0][0]).orderBy("h").limit(WORDS)
    return sorted(((r["h"], r["tail"], r["n"]) for r in chosen.collect()), key=lambda w: (-w[2], w[0]))


def _pieces(texts: DataFrame, lexicon: Lexicon, shards: int, seed: int = 11) -> DataFrame:
    """(shard, key, symbols) of every piece of PIECE tokens of ``texts`` (id, text); symbols as packed 16-bit numbers."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy().astype(np.int64).view(np.uint64)
            for a, b, words in blocks(batch.column(1), lower=True):
                hashes, tails, n = tokens(words)
                first = np.cumsum(n) - n
                count = -(-n // PIECE)
                number = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                start = np.repeat(first, count) + PIECE * number
                stop = np.minimum(start + PIECE, np.repeat(first + n, count))
                # a piece's key: that of its words, its document and its place there, so that copies part
                within = (np.arange(len(hashes)) - np.repeat(start, stop - start)).astype(np.uint64)
                run_sum = np.concatenate(([np.uint64(0)], np.cumsum(mix64(hashes.view(np.uint64) + within), dtype=np.uint64)))
                place = mix64(np.repeat(mix64(ids[a:b]), count) + number.astype(np.uint64))
                key = (mix64((run_sum[stop] - run_sum[start]) ^ (place + np.uint64(seed))) >> np.uint64(1)).astype(np.int64)
                symbols = lexicon.look_up(hashes, tails)[0].astype("<u2")
                edge = np.append(2 * start, 2 * len(symbols)).astype(np.int32)
                packed = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(edge), pa.py_buffer(symbols)])
                yield pa.RecordBatch.from_arrays([pa.array((key % shards).astype(np.int32)), pa.array(key), packed], names=["shard", "key", "symbols"])

    return texts.mapInArrow(run, "shard int, key long, symbols binary")


def _fitted(model: Gru, begin: int, rate: float, epochs: int, lanes: int):
    """Per shard, (shard, tokens, weights) of the model fitted on its pieces; a shard's rows lie together, in order.
    At most SHARD tokens are held, however many pieces a shard has."""
    def learn(own, parts):
        lengths = np.array([len(p) for p in parts]) // 2
        own.fit(np.frombuffer(b"".join(parts), "<u2").astype(np.int64), lengths, begin, epochs, rate, lanes)
        return int(lengths.sum())

    def row(shard, n, own):
        return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([n], pa.int64()), pa.array([own.packed()], pa.binary())],
                                          names=["shard", "tokens", "weights"])

    def run(batches):
        at, own, parts, size, n = None, None, [], 0, 0
        for batch in batches:
            for shard, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if shard != at or size >= 2 * SHARD:
                    if parts:
                        n += learn(own, parts)
                    if shard != at:
                        if at is not None:
                            yield row(at, n, own)
                        at, own, n = shard, model.with_weights(model.packed()), 0
                    parts, size = [], 0
                parts.append(piece)
                size += len(piece)
        if at is not None:
            yield row(at, n + learn(own, parts), own)
    return run


def _mean(table: pa.Table) -> pa.Table:
    """One model of a few: their mean by tokens."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("shard", "tokens", "weights"))))
    total = sum(r[1] for r in rows)
    mean = sum(r[1] / total * np.frombuffer(r[2], "<f4").astype(np.float64) for r in rows)
    return pa.table({"shard": pa.array([rows[0][0]], pa.int32()), "tokens": pa.array([total], pa.int64()),
                     "weights": pa.array([mean.astype("<f4").tobytes()], pa.binary())})


def _averaged(models: DataFrame, first: int, n: int) -> bytes:
    """The mean by tokens of at most ``n`` models of shards from ``first`` on: means of MERGED at once, so that no task
    and not the driver gets more."""
    reach = 1
    while n > MERGED:
        reach, n = reach * MERGED, -(-n // MERGED)
        models = models.groupBy(F.floor((F.col("shard") - first) / reach).alias("group")).applyInArrow(_mean, _MODEL)
    return _mean(pa.table({c: list(v) for c, v in zip(("shard", "tokens", "weights"), zip(*models.collect()))})).column("weights")[0].as_py()


def _trained(training: DataFrame, lexicon: Lexicon, all_n: int, id_col: str) -> Gru:
    """The model fitted on every token of all training documents: shards in turn or side by side, and averaged."""
    model = Gru(lexicon.edges, TAILS, lexicon.symbol_counts)
    shards = -(-all_n // SHARD)
    pieces = stored(_pieces(training.select(id_col, "text"), lexicon, shards), "pieces")
    # the first shard alone sets out; the others share what it found, in rounds
    edges = sorted({0, 1, *(1 + (shards - 1) * r // ROUNDS for r in range(1, ROUNDS + 1))})
    for r, (a, b) in enumerate(zip(edges, edges[1:])):
        own = pieces.where(F.col("shard").between(a, b - 1)).repartition(min(b - a, MAX_TASKS), "shard").sortWithinPartitions("shard", "key", "symbols")
        rate, epochs, lanes = (RATE, EPOCHS, TRAIN_LANES) if r == 0 else (RATE / 2 ** r, 1, SIDE)
        fitted = stored(own.select("shard", "symbols").mapInArrow(_fitted(model, lexicon.begin, rate, epochs, lanes), _MODEL), "models")
        if fitted.isEmpty():
            continue
        model = model.with_weights(_averaged(fitted, a, b - a))
        drop_stored(fitted)
    drop_stored(pieces)
    return model


def _rare_words(hashes: np.ndarray, n: np.ndarray, rare: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Per document, the different words that are not frequent and how often each occurs."""
    document, words = np.repeat(np.arange(len(n)), n)[rare], hashes[rare]
    order = np.lexsort((words, document))
    document, words = document[order], words[order]
    new = np.ones(len(words), dtype=bool)
    new[1:] = (words[1:] != words[:-1]) | (document[1:] != document[:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(words))).astype(np.int32)
    edge = pa.array(np.searchsorted(document[at], np.arange(len(n) + 1)).astype(np.int32))
    return pa.ListArray.from_arrays(edge, pa.array(words[at])), pa.ListArray.from_arrays(edge, pa.array(times))


def _scored(lexicon: Lexicon, model: Gru, id_col: str):
    rest = np.log10(lexicon.n_tail + lexicon.v_tail + 1.0)

    def counted(words: Words):
        """Of a block: symbols of the tokens; per document number, known ones, base, what tails add, rare words."""
        hashes, tails, n = tokens(words)
        symbols, counts = lexicon.look_up(hashes, tails)
        known = counts > 0
        first = np.cumsum(n) - n
        base = np.where(known, np.log10(np.maximum(counts, 0) + 1.0), 0.0)
        in_tail = np.where(symbols >= lexicon.words, base - rest[tails], 0.0)
        return (symbols.astype(np.int32), n, np.add.reduceat(known, first, dtype=np.int64), np.add.reduceat(base, first),
                np.add.reduceat(in_tail, first), *_rare_words(hashes, n, ~known))

    def out(ids, held, parts):
        symbols, n, known, base, in_tail = (np.concatenate(c) for c in list(zip(*parts))[:5])
        chance = model.log_likelihood(symbols, n, lexicon.begin)
        score = np.add.reduceat(chance, np.cumsum(n) - n) / np.log(10) + in_tail
        rare, times = (pa.concat_arrays(c) for c in list(zip(*parts))[5:])
        return pa.RecordBatch.from_arrays(
            [ids, held, *map(pa.array, (n.astype(np.int64), known, base, score)), rare, times],
            names=[id_col, "held_out", "n_tokens", "n_known", "base", "score", "rare", "times"])

    def run(batches):
        for batch in batches:
            a, parts, size = 0, [], 0
            for _, b, words in blocks(batch.column(2), lower=True):
                parts.append(counted(words))
                size += len(parts[-1][0])
                if size >= _TOKENS or b == len(batch):
                    yield out(batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), parts)
                    a, parts, size = b, [], 0
    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; scores are log10."""
    rows = docs.select(F.col(id_col).cast("long").alias(id_col), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    training = rows.where("not held_out")
    words = stored(word_counts(training, "text"), "word_counts")
    totals = words.groupBy("tail").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()  # a row per tail class
    of_tails = {r["tail"]: (r["n"], r["v"]) for r in totals}
    all_n, all_v = (sum(c) for c in zip(*of_tails.values())) if of_tails else (0, 0)
    base_rest = F.col("n_tokens") * F.log10(F.lit(float(all_n + all_v + 1)))
    names = [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    if not all_n:
        empty = Lexicon([(0, 0, 0)], {})
        part = rows.mapInArrow(_scored(empty, Gru(empty.edges, TAILS, empty.symbol_counts), id_col), _SCORED.format(id_col))
        return part.select("*", F.lit(0).cast("long").alias("train_tokens"), (-base_rest).alias("base_score")).select(
            *names[:-1], F.col("base_score").alias("score"))
    lexicon = Lexicon(_frequent(words), of_tails)
    model = _trained(training, lexicon, all_n, id_col)
    part = stored(rows.mapInArrow(_scored(lexicon, model, id_col), _SCORED.format(id_col)).withColumn(
        "row", F.monotonically_increasing_id()), "scored")
    # words that no training row has add log10(1) and are not known: an inner join leaves them out
    rare = part.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("h"), "r.times")
    more = rare.join(words, "h").groupBy("row").agg(F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"))
    both = part.drop("rare", "times").join(more, "row", "left")
    extra = F.coalesce("more", F.lit(0.0))
    return both.select(
        id_col, "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(all_n).cast("long").alias("train_tokens"), (F.col("base") + extra - base_rest).alias("base_score"),
        (F.col("score") + extra).alias("score"))


_MODEL = "shard int, tokens long, weights binary"
_SCORED = "`{}` long, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<long>, times array<int>"
