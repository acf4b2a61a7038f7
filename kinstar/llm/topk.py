"""Exact top-k search by inner product with an impact-ordered, score-at-a-time index.

Components are quantised to integer impacts, floor(256 * x). The vectors are cut
into shards of ``SHARD`` rows as they are read; each shard's index keeps, per
dimension, its postings in order of impact. For a query, the *gain* of a posting
is its contribution less the least one of its dimension in the shard, so gains
are never negative. Posting segments are processed in descending order of gain,
all dimensions together, down a ladder of thresholds: below threshold t every
posting still open adds less than t and no more than the best gain of its dimension,
so a vector with g gained ends between g and g plus these bounds over its open
dimensions. Vectors whose upper bound is below the k-th best lower bound are proven
out; all others are possible members. Processing stops only when no more than k members
are left, or with the last posting; the members are then rescored exactly. Once the members
have fewer postings than are open, only theirs are processed. On dense
vectors the bounds part late, so most postings are processed (README).

The stated query set is compared with all rows, in cells of one shard by
``QUERIES`` queries; each cell gives k rows per query, of which the k best
overall remain (Spark limits the ranks before its shuffle, too).

Vectors with an impact of 2**31 or more go to blocks of their own, whose scores are whole
numbers of any size; a score beyond the range of a long counts as the range's end.

Defined cases: vectors that are null, empty, or hold null or non-finite
components (also after the multiplication by 256), and null ids take no part; only vectors of one length are compared; rows
that repeat an id are candidates each, while a query id is asked once, with its
smallest vector; ties go to the smaller id; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinstar.llm.graph import stored

SHARD, QUERIES = 4096, 128
#: Blocks of queries that share one sending of a shard.
BLOCKS = 4
#: Steps of the ladder of thresholds: a quarter of the best gain, then half the one before, the last is 0.
STEPS = 5
#: Postings summed at once, so that what is made of them stays in the cache.
SUMMED = 1 << 15
MAX_TASKS = 50_000
_BLOCK = "dims int, wide boolean, ids binary, impacts binary"


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, impacts) of the vectors that take part; impacts are whole numbers as doubles."""
    scaled = F.transform(F.col(vector_col), lambda x: x.cast("double") * 256)
    fit = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # a double of 2**53 or more is a whole number
    whole = F.transform("x", lambda x: F.when(F.abs(x) < 2.0 ** 53, F.floor(F.when(F.abs(x) < 2.0 ** 53, x)).cast("double")).otherwise(x))
    return (vectors.select(F.col(id_col).cast("long").alias("id"), scaled.alias("x"))
            .where(F.col("id").isNotNull() & (F.size("x") > 0) & F.coalesce(fit, F.lit(False)))
            .select("id", whole.alias("impacts")))


def _blocks(size: int):
    """Rows of up to ``size`` vectors of equal length, as packed bytes: impacts as ints, or wide ones as doubles."""
    def run(batches):
        held: dict[tuple[int, bool], list] = {}

        def block(key: tuple[int, bool], parts: list):
            ids = np.concatenate([p[0] for p in parts])
            impacts = np.concatenate([p[1] for p in parts])
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]]), pa.array([ids.tobytes()], pa.binary()), pa.array([impacts.tobytes()], pa.binary())],
                names=["dims", "wide", "ids", "impacts"])

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(), batch.column(1)
            flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            lengths = np.diff(offsets)
            for dims in np.unique(lengths).tolist():
                of_length = np.flatnonzero(lengths == dims)
                matrix = flat[(offsets[of_length][:, None] + np.arange(dims)).ravel()].reshape(len(of_length), dims)
                wide = (np.abs(matrix) >= 2.0 ** 31).any(axis=1)
                for key, at in (((dims, False), np.flatnonzero(~wide)), ((dims, True), np.flatnonzero(wide))):
                    for a in range(0, len(at), size):
                        parts = held.setdefault(key, [])
                        some = at[a:a + size]
                        parts.append((ids[of_length[some]].astype("<i8"), matrix[some].astype("<f8" if key[1] else "<i4")))
                        if sum(len(p[0]) for p in parts) >= size:
                            yield block(key, held.pop(key))
        for key, parts in held.items():
            yield block(key, parts)
    return run


def _unpacked(dims: int, wide: bool, impacts: bytes) -> np.ndarray:
    matrix = np.frombuffer(impacts, "<f8" if wide else "<i4").reshape(-1, dims)
    return np.array([[int(x) for x in row] for row in matrix.tolist()], dtype=object).reshape(-1, dims) if wide else matrix.astype(np.int64)


def whole_scores(ids: np.ndarray, impacts: np.ndarray, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, list[int]]:
    """The k best by scores of any size, without an index."""
    members = np.flatnonzero(ids != query_id)
    scores = impacts[members].astype(object) @ query.astype(object) if len(members) else []
    scores = [min(max(int(s), -2 ** 63), 2 ** 63 - 1) for s in scores]
    rank = sorted(range(len(members)), key=lambda i: (-scores[i], ids[members[i]]))[:k]
    return ids[members[rank]], [scores[i] for i in rank]


def _runs(sizes: list[int], most: int) -> list[tuple[int, int]]:
    """Runs [a, b) of entries that hold together ``most`` at least, but for the last."""
    runs, a, held = [], 0, 0
    for b, size in enumerate(sizes, 1):
        held += size
        if held >= most:
            runs.append((a, b))
            a, held = b, 0
    return [*runs, (a, len(sizes))] if held else runs


class Shard:
    """The impact-ordered index of one block of vectors: per dimension, the
    postings by ascending impact."""

    def __init__(self, ids: np.ndarray, impacts: np.ndarray):
        self.ids, self.impacts = ids, impacts.astype(np.int64)
        n, dims = self.impacts.shape
        order = np.argsort(self.impacts, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(self.impacts.T, order, axis=1)
        self.postings, self.values = order.ravel(), self.sorted.ravel().astype(np.float64)
        self.base = np.arange(dims) * n
        # dimension and impact in one ascending key, to look up all dimensions at once
        self.least, self.span = int(self.impacts.min()), int(self.impacts.max() - self.impacts.min()) + 2
        self.keys = (np.arange(dims)[:, None] * self.span + (self.sorted - self.least)).ravel()
        self.rows = self.impacts.astype(np.float64)

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of this shard's k best."""
        n = len(self.ids)
        members = others = np.flatnonzero(self.ids != query_id)
        dims = np.flatnonzero(query)
        w = query[dims]
        # best-first per dimension: from the top of the impacts, or from the bottom for negative weights
        up = w > 0
        ends = w * self.sorted[dims, 0], w * self.sorted[dims, -1]
        least, best = np.where(up, *ends), np.abs(ends[1] - ends[0])
        top = int(best.max(initial=0))
        most = int(np.abs(query).max(initial=0)) * int(np.abs(self.impacts).max()) * len(query)
        if most >= 2 ** 63:
            return whole_scores(self.ids, self.impacts, query_id, query, k)
        # a posting adds ``unit`` and its gain, so that one sum holds the number of postings, too
        unit = 1 << (2 * most + 1).bit_length()
        if unit * (len(dims) + 1) >= 2 ** 52:
            # beyond exact doubles: score the whole shard in integers
            scores = self.impacts[members] @ query
        else:
            summed, weights, shift = np.zeros(n), w.astype(np.float64), (unit - least).astype(np.float64).tolist()
            factor = weights.tolist()
            held, of = np.empty(SUMMED + n), np.empty(SUMMED + n, dtype=np.int64)
            done = np.zeros(len(dims), dtype=np.int64)  # postings processed per dimension
            gains = None  # of the members by dimension, once they are few
            for step in range(1, STEPS + 1):
                if len(members) <= k or not top:
                    break
                t = top >> step + 1 if step < STEPS else 0
                if gains is None:
                    # gain >= t  <=>  weight * impact >= t + least
                    edge = t + least
                    bound = np.where(up, -(-edge // w), edge // w + 1)
                    first = np.searchsorted(self.keys, dims * self.span + np.clip(bound - self.least, 0, self.span - 1)) - self.base[dims]
                    reach = np.where(up, n - first, first)
                    size = (reach - done).tolist()
                    start = (self.base[dims] + np.where(up, n - reach, done)).tolist()
                    for a, b in _runs(size, SUMMED):
                        end = 0
                        for x, y, weight, more in zip(start[a:b], size[a:b], factor[a:b], shift[a:b]):
                            if y:
                                part = held[end:end + y]
                                np.multiply(self.values[x:x + y], weight, out=part)
                                part += more
                                of[end:end + y] = self.postings[x:x + y]
                                end += y
                        summed += np.bincount(of[:end], held[:end], minlength=n)
                    done, among = reach, others
                    begun = np.floor(summed[among] / unit)
                    low = summed[among] - begun * unit
                else:
                    reached, among = gains >= t, members
                    begun, low = np.count_nonzero(reached, axis=1), np.where(reached, gains, 0.0).sum(axis=1)
                enough = np.partition(low, len(low) - k)[len(low) - k] if len(low) > k else -1
                # open postings gain less than t; dimensions that end below t are open in all rows
                less, short = max(0, t - 1), best < t
                rest = int(best[short].sum()) + (np.count_nonzero(~short) - begun) * less
                left = low + rest >= enough
                members = among[left]
                if gains is not None:
                    gains = gains[left]
                elif len(members) * len(dims) < n * len(dims) - int(done.sum()):
                    # the members have fewer postings than are open: go on with theirs alone
                    gains = self.rows[members]
                    gains = (gains if len(dims) == len(query) else gains[:, dims]) * weights - least
            scores = (self.rows[members] @ query.astype(np.float64)).astype(np.int64)
        rank = np.lexsort((self.ids[members], -scores))[:k]
        return self.ids[members[rank]], scores[rank]


def _searched(k: int):
    def run(batches):
        held: dict[int, Shard] = {}  # the indexes of one group of shards
        for batch in batches:
            for dims, number, wide, ids, impacts, q_wide, q_ids, q_impacts in zip(*(batch.column(i).to_pylist() for i in range(8))):
                out = [[], [], []]
                queries = _unpacked(dims, q_wide, q_impacts)
                if wide or q_wide:
                    of, rows = np.frombuffer(ids, "<i8"), _unpacked(dims, wide, impacts)
                elif number not in held:
                    if len(held) >= 16:
                        held.pop(next(iter(held)))
                    held[number] = Shard(np.frombuffer(ids, "<i8"), _unpacked(dims, False, impacts))
                for query_id, query in zip(np.frombuffer(q_ids, "<i8").tolist(), queries):
                    found, scores = (whole_scores(of, rows, query_id, query, k) if wide or q_wide
                                     else held[number].search(query_id, query, k))
                    out[0].append(np.full(len(found), query_id))
                    out[1].append(found)
                    out[2].append(np.array(scores, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in out],
                                                 names=["query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
          k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k best other rows."""
    index = stored(quantised(vectors, id_col, vector_col).mapInArrow(_blocks(SHARD), _BLOCK)
                   .withColumn("shard", F.monotonically_increasing_id()), "index")
    asked = quantised(vectors.where(is_query), id_col, vector_col).groupBy("id").agg(F.min("impacts").alias("impacts"))
    # Every block of queries meets every shard. Blocks of queries are dealt into
    # groups, so that a shard is sent once for a few of them, and cells to as many
    # places as there are shards and groups.
    places, groups = max(1, index.count()), max(1, -(-asked.count() // (QUERIES * BLOCKS)))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    queries = asked.mapInArrow(_blocks(QUERIES), _BLOCK).select(
        "dims", F.col("wide").alias("q_wide"), F.col("ids").alias("q_ids"), F.col("impacts").alias("q_impacts"),
        F.pmod(F.xxhash64("ids"), F.lit(groups).cast("long")).alias("part"), every(places).alias("place"))
    # a fixed number of tasks: Spark would merge them by their bytes, but the work is in the cells
    keys, tasks = ["dims", "place", "part"], min(places * groups, MAX_TASKS)
    cells = (index.select("*", F.pmod(F.xxhash64("shard"), F.lit(places).cast("long")).alias("place"),
                          every(groups).alias("part")).repartition(tasks, *keys)
             .join(queries.repartition(tasks, *keys), keys))
    found = cells.select("dims", "shard", "wide", "ids", "impacts", "q_wide", "q_ids", "q_impacts").mapInArrow(
        _searched(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
