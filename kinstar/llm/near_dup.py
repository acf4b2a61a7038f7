"""Near-duplicate documents by b-bit MinHash, links confirmed on full sets.

1. One scan computes each document's distinct word shingles, a fingerprint of
   that set, ``bands * rows`` hash minima, a key per band, and the packed
   signature: the lowest ``BITS`` bits of every minimum.
2. Documents with equal sets are one class; its smallest id stands for it, so
   a group of copies costs one row from here on.
3. Representatives that share a band key are candidates. Buckets with the same
   members are looked at once. A bucket is compared in square blocks of at
   most about ``2 * BLOCK`` signatures; agreement is counted on the packed bits
   and corrected for chance collisions (2**-BITS of unequal minima agree). A
   block passes on a spanning forest of the pairs whose estimate lies within
   the estimator's error of the threshold, never all pairs.
4. The connected groups of these links are compared on full shingle sets, again
   in blocks, each passing on a spanning forest of its confirmed links.
5. Connected components of the confirmed links give the result.

A pair at the threshold is missed by all bands with probability
(1 - t**rows)**bands, below 2e-5 with :func:`bands_for` (23 bands of 6 at 0.85,
36 at 0.8), and by the estimate with about 3e-6 (``SIGMAS`` standard errors).

Defined cases: null or blank texts have an empty set and no links; a null id
has no links and a null component (``kept`` true); rows with one id count as
one vertex; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinstar.llm.cells import cells_of, grouped
from kinstar.llm.graph import connected_components, stored
from kinstar.llm.words import blocks, mix64, shingle_set

BITS = 2
#: Members of a bucket or group on one side of a comparison.
BLOCK = 256
#: Standard errors below the threshold at which an estimate still passes.
SIGMAS = 4.5
_PART = 8192


def bands_for(threshold: float, rows: int = 6, miss: float = 2e-5) -> int:
    """Bands needed so that a pair at the threshold shares none with probability <= miss."""
    return int(np.ceil(np.log(miss) / np.log(1 - threshold ** rows)))


def _family(n: int) -> tuple[np.ndarray, np.ndarray]:
    a = mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    b = mix64(a + np.uint64(77))
    return a.astype(np.uint32) | np.uint32(1), b.astype(np.uint32)


def minima(shingles: np.ndarray, n: int) -> np.ndarray:
    """The n hash minima of a non-empty shingle set."""
    a, b = _family(n)
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(n, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(low), _PART):
        part = low[None, i:i + _PART] * a[:, None]
        part += b[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


def pack(least: np.ndarray) -> bytes:
    """The lowest BITS bits of every minimum, packed."""
    bits = (least[:, None] >> np.arange(BITS, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).ravel()).tobytes()


def agreement(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Collision-corrected similarity estimates of packed signatures (rows of a by rows of b)."""
    x = a[:, None, :] ^ b[None, :, :]
    # a slot of two bits differs if either bit does
    differ = np.bitwise_count((x | (x >> 1)) & np.uint8(0x55)).sum(axis=2, dtype=np.int32)
    chance = 0.5 ** BITS
    return ((n - differ) / n - chance) / (1 - chance)


def estimate_cut(threshold: float, n: int) -> float:
    """Lowest estimate that passes."""
    p = threshold + (1 - threshold) * 0.5 ** BITS
    return threshold - SIGMAS * np.sqrt(p * (1 - p) / n) / (1 - 0.5 ** BITS)


_SIGNED = "n_shingles long, fa long, fb long, bands array<long>, sig binary"


def signatures(df: DataFrame, id_col: str, text_col: str, k: int, bands: int, rows: int) -> DataFrame:
    """(id, n_shingles, fa, fb, bands, sig) per row; fa and fb fingerprint the set."""
    def scan(batches):
        salt = mix64(np.arange(1, bands + 1, dtype=np.uint64))
        for batch in batches:
            for row, end, words in blocks(batch.column(1), lower=True):
                n, fa, fb, keys, sigs = [], [], [], [], []
                for d in range(end - row):
                    s = shingle_set(words.hashes[words.first[d]:words.first[d + 1]], k)
                    n.append(len(s))
                    fa.append(int(np.add.reduce(mix64(s)).view(np.int64)) if len(s) else 0)
                    fb.append(int(np.bitwise_xor.reduce(s).view(np.int64)) if len(s) else 0)
                    if not len(s):
                        keys.append(None)
                        sigs.append(None)
                        continue
                    least = minima(s, bands * rows)
                    key = salt.copy()
                    for col in least.reshape(bands, rows).T:
                        key = mix64(key ^ col)
                    keys.append(key.view(np.int64))
                    sigs.append(pack(least))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(n, pa.int64()), pa.array(fa, pa.int64()),
                     pa.array(fb, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                    names=["id", "n_shingles", "fa", "fb", "bands", "sig"])
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        scan, "id long, " + _SIGNED)


class Forest:
    """Connected members of a cell: a label for each, the smallest of its tree."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` that are not connected with i, one for each tree."""
        others = others[self.label[others] != self.label[i]]
        return others[np.unique(self.label[others], return_index=True)[1]]

    def join(self, i: int, j: int) -> None:
        a, b = self.label[i], self.label[j]
        self.label[self.label == max(a, b)] = min(a, b)


def _passes(sides: np.ndarray):
    """(rows, partners, whether their links are passed on) of the comparisons of a cell.

    The links inside a block come from its own cell. In a cell of two blocks they
    are only joined, so that a link is passed on if it connects something new.
    """
    left, right = np.flatnonzero(sides[0]), np.flatnonzero(sides[1])
    if np.array_equal(left, right):
        return [(left, left, True)]
    return [(left, left, False), (right, right, False), (left, right, True)]


def _estimated(n: int, cut: float):
    """Links of a cell whose estimates pass (a spanning forest)."""
    def compare(cell: pa.Table, sides: np.ndarray):
        ids = cell.column("id").to_numpy()
        sig = np.frombuffer(b"".join(cell.column("sig").to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
        forest = Forest(len(ids))
        for left, right, told in _passes(sides):
            for part in range(0, len(left), 32):
                rows = left[part:part + 32]
                for i, passed in zip(rows, agreement(sig[rows], sig[right], n) >= cut):
                    for j in forest.apart(i, right[passed]):
                        forest.join(i, j)
                        if told:
                            yield ids[i], ids[j]
    return compare


def _confirmed(k: int, num: int, den: int):
    """Links of a cell by exact set comparison (a spanning forest)."""
    def compare(cell: pa.Table, sides: np.ndarray):
        ids = cell.column("id").to_numpy()
        sets = []
        for row, end, words in blocks(cell.column("text"), lower=True):
            sets += [shingle_set(words.hashes[words.first[d]:words.first[d + 1]], k) for d in range(end - row)]
        sizes = np.array([len(s) for s in sets])
        every = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        forest = Forest(len(ids))
        shared: dict[int, np.ndarray] = {}

        def common(i: int) -> np.ndarray:
            """Intersection sizes of document i with all of the cell."""
            if i not in shared:
                lo, hi = np.searchsorted(every, sets[i], "left"), np.searchsorted(every, sets[i], "right")
                spans = hi - lo
                at = np.repeat(lo - np.concatenate(([0], np.cumsum(spans)[:-1])), spans) + np.arange(spans.sum())
                shared[i] = np.bincount(owner[at], minlength=len(sets))
            return shared[i]

        for left, right, told in _passes(sides):
            for i in left.tolist():
                # partners of fitting size that are not connected yet
                fit = den * np.minimum(sizes[right], sizes[i]) >= num * np.maximum(sizes[right], sizes[i])
                open_ = right[fit]
                open_ = open_[forest.label[open_] != forest.label[i]]
                if not len(open_) or not sizes[i]:
                    continue
                both = common(i)[open_]
                for j in forest.apart(i, open_[den * both >= num * (sizes[i] + sizes[open_] - both)]):
                    forest.join(i, j)
                    if told:
                        yield ids[i], ids[j]
    return compare


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
                    num: int = 85, den: int = 100, rows: int = 6, bands: int | None = None) -> DataFrame:
    """(id, n_shingles, component_id, kept) per row of ``df``; documents with
    ``den * intersection >= num * union`` of their k-word shingles are linked."""
    bands = bands or bands_for(num / den, rows)
    n = bands * rows
    signed = stored(signatures(df, id_col, text_col, k, bands, rows), "minhash")
    filled = signed.where("id is not null and n_shingles > 0")
    one = stored(filled.groupBy("fa", "fb", "n_shingles").agg(
        F.min("id").alias("rep"), F.first("bands").alias("bands"), F.first("sig").alias("sig")), "classes")

    banded = one.select(F.explode("bands").alias("key"), "rep")
    buckets = (banded.groupBy("key").agg(F.count("*").alias("size"), F.sum(F.xxhash64("rep").cast("decimal(20,0)")).alias("who"))
               .where("size > 1").groupBy("who", "size").agg(F.min("key").alias("key")))
    members = banded.join(buckets.select("key", "size"), "key").select("key", "size", F.col("rep").alias("id"))
    members = members.join(one.select(F.col("rep").alias("id"), "sig"), "id")
    maybe = grouped(cells_of(members, "key", "id", "size", BLOCK), _estimated(n, estimate_cut(num / den, n)))

    group = connected_components(maybe)
    group = group.join(group.groupBy("component").agg(F.count("*").alias("size")), "component")
    # a merge join whatever the sizes: a corpus has too many members of groups to broadcast
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).hint("merge").join(group, "id")
    sure = grouped(cells_of(texts, "component", "id", "size", BLOCK), _confirmed(k, num, den))
    linked = connected_components(sure)

    answer = one.select("fa", "fb", "n_shingles", F.col("rep").alias("r")).join(
        linked.withColumnRenamed("id", "r"), "r", "left").select(
        "fa", "fb", "n_shingles", F.coalesce("component", "r").alias("found"))
    return (signed.select("id", "fa", "fb", "n_shingles").join(answer, ["fa", "fb", "n_shingles"], "left")
            .select(F.col("id").alias(id_col), "n_shingles",
                    F.when(F.col("id").isNotNull(), F.coalesce("found", "id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))
