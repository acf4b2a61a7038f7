"""Removal of word sequences that occur earlier in the corpus, by level-wise doubling.

Lengths double from a few words up to ``window`` (5, 10, 20 at the default), and only
what is repeated at one length is extended to twice that length, until no candidates
survive or the full windows are reached:

* A full window's *seed* is the half-length window inside it with the smallest hash, the
  seed's own seed is its half with the smallest hash, and so on: a chain of nested windows,
  shared by about six neighbouring full windows. Equal windows have equal chains, so a
  window whose chain holds a sequence that occurs once cannot be repeated.
* Each level counts its windows over all documents, among the chains that survived the
  level below; chains whose window occurs once go.
* The full windows around the surviving chains are hashed, and each hash's smallest
  document id is found. Longer repeats are covered by the repeated windows of this
  length, so the removal needs no longer ones.

A word goes if some window over it also starts earlier: in a document with a
smaller id, or earlier in its own. All windows are judged on the input. Whole
copies (same word sequence) lose all words if they have a full window; they
are recognised by a fingerprint and take no part in the last level, as their first
copy has all their windows.

Windows are compared by 64-bit hashes. Counts and first documents are map-side combined
aggregates. A window may occur everywhere: the join that brings a count back to its
occurrences splits them by a salt of the document, at the lowest level for all windows,
above it for those whose chain was seen more than ``HOT`` times below. Each count carries
the salts that occur, so it goes to those parts alone.

Defined cases: null and blank texts have no words; rows with a null id are
returned whole and are nobody's earlier occurrence; of rows that share an id
with different texts neither is earlier; a very long text is hashed as a block of its own
and its surviving windows are one row of a table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinstar.llm.graph import drop_stored, stored
from kinstar.llm.words import Words, blocks, column_bytes, mix64, window_hashes

#: Parts into which the occurrences of a window are split (at most 63), and the count from
#: which that is done above the lowest level.
SALTS, HOT = 32, 1000
_KEY = ["id", "tk"]
_EMPTY = hashlib.sha256(b"").hexdigest()


def _list_array(values: np.ndarray, offsets: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def level_lengths(window: int) -> list[int]:
    """The lengths of the levels: ``window``, its half, and further halves down to four words."""
    lengths = [window, window // 2]
    while lengths[-1] % 2 == 0 and lengths[-1] >= 8:
        lengths.append(lengths[-1] // 2)
    return lengths[::-1]


def _chains(words: Words, lengths: list[int]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Window starts that fit into their document, the chain of each, and per level
    below the full length the position of each chain's window."""
    lasts = np.repeat(words.first[1:], np.diff(words.first))
    fits = np.flatnonzero(np.arange(len(lasts)) + lengths[-1] <= lasts)
    at, chain, levels = fits, np.zeros(0, dtype=np.int64), []
    for size in lengths[-2::-1]:
        if len(at):
            order = mix64(window_hashes(words.hashes, size) + np.uint64(1))
            at = at + np.lib.stride_tricks.sliding_window_view(order, size + 1).argmin(axis=1)[at]
        if not levels:
            at, chain = np.unique(at, return_inverse=True)
        levels.append(at)
    return fits, chain, levels[::-1]


def _scan(lengths: list[int]):
    names = [f"h{i}" for i in range(len(lengths) - 1)]

    def run(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(2))
            for row, end, words in blocks(batch.column(2)):
                _, _, levels = _chains(words, lengths)
                edges = np.searchsorted(levels[-1], words.first)
                # neighbouring chains may share a window of a level: the first one counts it
                fresh = np.zeros(len(levels[0]), dtype=np.int32)
                for i, at in enumerate(levels):
                    fresh |= np.r_[True, at[1:] != at[:-1]].astype(np.int32)[:len(at)] << i
                n = np.diff(words.first)
                fa, fb, sha = [], [], []
                for d in range(end - row):
                    h = words.hashes[words.first[d]:words.first[d + 1]]
                    whole = int(window_hashes(h, len(h)).view(np.int64)[0]) if len(h) else 0
                    fa.append(whole)
                    fb.append(int(np.add.reduce(mix64(h)).view(np.int64)) if len(h) else 0)
                    text = data[offsets[row + d]:offsets[row + d + 1]].tobytes()
                    sha.append(hashlib.sha256(b" ".join(text.split())).hexdigest())
                hashes = [_list_array(window_hashes(words.hashes, size)[at].view(np.int64), edges, pa.int64())
                          for size, at in zip(lengths, levels)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), batch.column(1).slice(row, end - row),
                     pa.array(n, pa.int64()), pa.array(fa, pa.int64()), pa.array(fb, pa.int64()), pa.array(sha),
                     *hashes, _list_array(fresh, edges, pa.int32())],
                    names=["id", "tk", "n_words", "fa", "fb", "sha", *names, "fresh"])
    return run


def _candidates(lengths: list[int]):
    """Full windows around surviving chains: first occurrences in the document
    (hashes, starts, whether their chain is hot), and the starts of its own later ones."""
    def run(batches):
        for batch in batches:
            known, hot = batch.column(3), batch.column(4)
            for row, end, words in blocks(batch.column(2)):
                fits, chain, levels = _chains(words, lengths)
                seeds = window_hashes(words.hashes, lengths[-2])[levels[-1]]
                full = window_hashes(words.hashes, lengths[-1])
                edge = np.searchsorted(fits, words.first)
                hs, ss, warm, again = [], [], [], []
                for d in range(end - row):
                    a, b = edge[d], edge[d + 1]
                    mine = known[row + d].values.to_numpy().view(np.uint64)
                    inside = np.isin(seeds[chain[a:b]], mine)
                    s, seed = fits[a:b][inside], seeds[chain[a:b]][inside]
                    h, first = np.unique(full[s], return_index=True)
                    later = np.ones(len(s), dtype=bool)
                    later[first] = False
                    hs.append(h.view(np.int64))
                    ss.append(s[first] - words.first[d])
                    warm.append(np.isin(seed[first], hot[row + d].values.to_numpy().view(np.uint64)))
                    again.append(s[later] - words.first[d])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), batch.column(1).slice(row, end - row),
                     batch.column(2).slice(row, end - row), pa.array(hs, pa.list_(pa.int64())),
                     pa.array(ss, pa.list_(pa.int32())), pa.array(warm, pa.list_(pa.bool_())), pa.array(again, pa.list_(pa.int32()))],
                    names=["id", "tk", "text", "hashes", "starts", "hot", "again"])
    return run


def _salted(rows: DataFrame, h: str) -> DataFrame:
    """Adds the part (salt) of a row of a hot window, and the key of its window and part."""
    rows = rows.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).otherwise(0))
    return rows.withColumn("key", F.col(h).bitwiseXOR(F.xxhash64("salt")))


def _per_part(counts: DataFrame, h: str, *columns) -> DataFrame:
    """A row per window and part of ``counts``, whose ``parts`` has a bit for each salt."""
    salts = F.expr(f"filter(sequence(0, {SALTS - 1}), s -> bit_get(parts, s) = 1)")
    return counts.withColumn("salt", F.explode(salts)).select(F.col(h).bitwiseXOR(F.xxhash64("salt")).alias("key"), *columns)


_PARTS = "bit_or(shiftleft(1L, salt))"


def surviving(chains: DataFrame, levels: int) -> DataFrame:
    """(id, tk, h, hot) of the chains' windows of the longest of ``levels`` that are repeated at
    every level; ``chains`` has their hashes h0, h1, ... and ``fresh``, with a bit for each level."""
    rows = chains.withColumn("hot", F.lit(True))
    for level in range(levels):
        h = f"h{level}"
        rows = _salted(rows, h)
        counts = rows.groupBy(h).agg(F.sum(F.expr(f"bit_get(fresh, {level})").cast("long")).alias("n"),
                                     F.expr(_PARTS).alias("parts")).where("n > 1")
        longer = [f"h{i}" for i in range(level + 1, levels)]
        rows = rows.drop("hot").join(_per_part(counts, h, (F.col("n") > HOT).alias("hot")), "key").select(
            *_KEY, *(longer or [F.col(h).alias("h")]), *(["fresh"] if longer else []), "hot")
        if longer:
            rows = stored(rows, "level")
            if rows.isEmpty():
                return rows.select(*_KEY, F.col(longer[0]).alias("h"), "hot")
    return rows


def _removal(window: int):
    def run(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(2))
            gone, sha, texts = [], [], []
            for d in range(batch.num_rows):
                words = data[offsets[d]:offsets[d + 1]].tobytes().split()
                starts = batch.column(3)[d].values.to_numpy()
                step = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(step, starts, 1)
                np.add.at(step, starts + window, -1)
                covered = np.cumsum(step[:-1]) > 0
                kept = b" ".join([words[i] for i in np.flatnonzero(~covered)])
                gone.append(int(covered.sum()))
                sha.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(gone, pa.int64()), pa.array(sha),
                 pa.array(texts, pa.binary()).cast(pa.string())], names=["id", "tk", "gone", "sha", "kept_text"])
    return run


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20,
                   with_text: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) per row of ``df``, for an even ``window``;
    ``with_text`` adds the kept words as ``kept_text`` (null where nothing was removed)."""
    if window < 2 or window % 2:
        raise ValueError("window must be even")
    lengths = level_lengths(window)
    docs = df.select(F.col(id_col).cast("long").alias("id"),
                     F.xxhash64(text_col).alias("tk"), F.col(text_col).cast("string").alias("text"))
    if not docs.groupBy("id").count().where("count > 1 and id is not null").limit(1).count():
        docs = docs.withColumn("tk", F.lit(0).cast("long"))  # the id alone tells rows apart
    names = [f"h{i}" for i in range(len(lengths) - 1)]
    scanned = stored(docs.mapInArrow(_scan(lengths), "id long, tk long, n_words long, fa long, fb long, sha string, "
                                     + "".join(f"{h} array<long>, " for h in names) + "fresh array<int>"), "scan")
    long = scanned.where(F.col("id").isNotNull() & (F.col("n_words") >= window))
    whole = _salted(long.select(*_KEY, "fa", "fb", "n_words", F.lit(True).alias("hot")), "fa")
    firsts = whole.groupBy("fa", "fb", "n_words").agg(F.min("id").alias("first"), F.max("id").alias("last"),
                                                      F.expr(_PARTS).alias("parts")).where("first < last")
    copies = (whole.select(*_KEY, "key", "fb", "n_words").join(_per_part(firsts, "fa", "fb", "n_words", "first"),
                                                               ["key", "fb", "n_words"])
              .where("id <> first").select(*_KEY).distinct())
    copies = stored(copies, "copies")

    chains = long.select(*_KEY, F.explode(F.arrays_zip(*names, "fresh")).alias("c")).select(*_KEY, "c.*")
    found = surviving(chains, len(names)).groupBy(_KEY).agg(
        F.collect_set("h").alias("known"), F.collect_set(F.when(F.col("hot"), F.col("h"))).alias("hot"))
    found = found.join(copies, _KEY, "left_anti")
    tried = stored(docs.join(found, _KEY).select(*_KEY, "text", "known", "hot").mapInArrow(
        _candidates(lengths), "id long, tk long, text string, hashes array<long>, starts array<int>, "
                              "hot array<boolean>, again array<int>"), "windows")
    heads = stored(scanned.select(*_KEY, "n_words", "sha"), "heads")
    drop_stored(scanned)
    rows = _salted(tried.select(*_KEY, F.explode(F.arrays_zip("hashes", "starts", "hot")).alias("w")).select(
        *_KEY, F.col("w.hashes").alias("h"), F.col("w.starts").alias("start"), F.col("w.hot").alias("hot")), "h")
    first = rows.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.expr(_PARTS).alias("parts")).where("lo < hi")
    covered = rows.select(*_KEY, "start", "key").join(_per_part(first, "h", "lo"), "key").where("id <> lo").select(*_KEY, "start")
    own = tried.select(*_KEY, F.explode("again").alias("start"))
    spans = covered.union(own).groupBy(_KEY).agg(F.collect_set("start").alias("starts"))
    cut = tried.select(*_KEY, "text").join(spans, _KEY).select(*_KEY, "text", "starts").mapInArrow(
        _removal(window), "id long, tk long, gone long, sha string, kept_text string").dropDuplicates(_KEY)
    if not with_text:
        cut = cut.drop("kept_text")
    gone = cut.withColumnRenamed("sha", "cut_sha").unionByName(
        copies.withColumn("gone", F.lit(-1).cast("long")).withColumn("cut_sha", F.lit(_EMPTY)), allowMissingColumns=True)
    answer = heads.join(gone, _KEY, "left")
    columns = [F.col("id").alias(id_col), "n_words",
               F.when(F.col("gone") < 0, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))).cast("long").alias("n_removed"),
               F.coalesce("cut_sha", "sha").alias("kept_sha256")]
    return answer.select(*columns, *(["kept_text"] if with_text else []))
