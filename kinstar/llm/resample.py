"""Resampling of documents towards a target distribution by hashed n-gram features.

Words are runs of ASCII letters and digits (capitals lowered) and of characters
beyond ASCII. Features are all runs of one to three consecutive words, joined by one
space; a feature's bucket is its CRC-32 modulo ``BUCKETS``, taken from a position
table over the bytes of many features at once (``crc.py``). Two passes read the
texts:

1. bucket counts of all documents and of all target texts: every task counts into
   one array of ``BUCKETS`` numbers, and Spark adds them up;
2. with the gains of the buckets (a bounded array that the tasks get), each
   document's weight is the sum of the gains of its features.

score = weight + Gumbel noise that depends on the document's id alone, so that the
documents with the highest scores are a draw without replacement by weight. They are
ranked without a sort in one task: rows are range-partitioned by score, and ranks are
offsets plus positions (K1).

Defined cases: null and blank texts have no features and weight 0; rows with a null id
are returned with a null score, are not drawn and do not count among the documents
that the draw is a share of, but their texts count in the buckets; rows that repeat an
id are drawn each (rows with equal texts then share score and get ranks in any order);
without target texts or documents the counts are 0; texts are read whole, in blocks,
however long; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinstar.llm.crc import crc32_of_spans
from kinstar.llm.graph import stored
from kinstar.llm.words import BARE, Words, blocks
from kinstar.operators.keys import with_surrogate_key

BUCKETS = 10_000
#: Words of a feature at most.
ORDERS = 3
#: Documents with fewer words are not drawn.
LEAST_WORDS = 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def features(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per feature length: (number of the first word, bucket) of every feature."""
    lengths = words.ends - words.starts
    n = len(lengths)
    # the lowered words of the block, with one space behind each
    line = np.full(int(lengths.sum()) + n, 32, dtype=np.uint8)
    starts = np.cumsum(lengths + 1) - lengths - 1
    k = np.arange(int(lengths.sum()))
    line[k + np.repeat(np.arange(n), lengths)] = _LOWER[words.data[k + np.repeat(words.starts - (starts - np.arange(n)), lengths)]]
    ends, document = starts + lengths, np.repeat(np.arange(len(words)), np.diff(words.first))
    out = []
    for order in range(1, ORDERS + 1):
        last = np.arange(order - 1, n)
        first = last - (order - 1)
        whole = document[first] == document[last]
        first, last = first[whole], last[whole]
        out.append((first, crc32_of_spans(line, starts[first], ends[last]) % np.uint32(BUCKETS)))
    return out


def bucket_counts(texts: DataFrame, text_col: str = "text") -> np.ndarray:
    """How many features of all texts each bucket holds."""
    def run(batches):
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for _, _, words in blocks(batch.column(0), lower=True, space=BARE):
                for _, bucket in features(words):
                    counts += np.bincount(bucket, minlength=BUCKETS)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(counts[held])], names=["bucket", "n"])

    found = texts.select(F.col(text_col).cast("string")).mapInArrow(run, "bucket int, n long")
    out = np.zeros(BUCKETS, dtype=np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row per bucket at most
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of a bucket's smoothed shares, rounded down."""
    all_s, all_t = int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (all_s + BUCKETS) / ((s + 1) * (all_t + BUCKETS))))
                     for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_features, weight) of every row."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for a, b, words in blocks(batch.column(1), lower=True, space=BARE):
                total = np.zeros(b - a, dtype=np.int64)
                number = np.zeros(b - a, dtype=np.int64)
                for first, bucket in features(words):
                    run_sum = np.concatenate(([0], np.cumsum(gain[bucket])))
                    edge = np.searchsorted(first, words.first)
                    total += np.diff(run_sum[edge])
                    number += np.diff(edge)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(np.diff(words.first), pa.int64()), pa.array(number), pa.array(total)],
                    names=[id_col, "n_words", "n_features", "weight"])

    return docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string")).mapInArrow(
        run, f"`{id_col}` long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (5, 100), seed: int = 42,
             id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """(id, n_features, weight, score, rank) of every row; ``rank`` is that of the drawn rows
    (``share`` of those with LEAST_WORDS words, rounded down), else null."""
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_text))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)
    h = F.conv(F.substring(key, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(float(2 ** 32)))))
    scored = stored(weights(docs, gain, id_col, text_col).withColumn("score", F.col("weight") + noise).withColumn(
        "place", F.monotonically_increasing_id()), "scored")
    may = F.col(id_col).isNotNull() & (F.col("n_words") >= LEAST_WORDS)
    drawn = share[0] * scored.where(may).count() // share[1]
    # equal scores and ids are told apart by the row, so that no key of the sort is shared by many rows
    ranked = with_surrogate_key(scored.where(may), [F.col("score").desc(), F.col(id_col), F.col("place")], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.where(~may).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(id_col, "n_features", "weight", "score", "rank")
