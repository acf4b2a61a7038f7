"""Packing of token sequences into windows by Karmarkar-Karp multiway differencing.

Every document's tokens (with an end id) are cut into full windows and a rest;
rests longer than ``PIECE`` are cut once more, which leaves the differencing
small numbers to balance with. Pieces are packed in groups of ``GROUP``: starting
from partial partitions of one piece each (sums over k windows, all but one
empty), the two with the largest imbalance are merged, the largest sums of one
upon the smallest of the other, until one partition is left, whose windows are
nearly equal. If one exceeds the capacity, the number of windows rises by one
and the group is packed again, starting from ceil(tokens / capacity) windows.

Documents are tokenised and packed where they are read: no token is shuffled, a
group has a fixed size, and sequence ids carry the partition in their upper
bits. A repeated task gives the same pieces.

Defined cases: a null or empty text is just its end id; repeated rows are packed
as often as they occur; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinstar.llm.tokens import bpe_encoder

#: Pieces of a group; the largest piece that is not a full window, as a share of the capacity.
GROUP, PIECE = 2048, 0.25


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Partition of the indices of ``sizes`` into k nearly equal windows (largest differencing method)."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    heap: list[tuple] = []
    # A partial partition: sums in descending order (without the empty windows) and their members.
    # Two partitions without k filled windows between them merge by lying side by side; in
    # descending order single pieces always meet like that, k at a time.
    for at in range(0, len(order), k):
        run = order[at:at + k]
        sums = np.array([sizes[i] for i in run], dtype=np.int64)
        if len(run) < k:
            sums = np.concatenate([sums, np.zeros(k - len(run), dtype=np.int64)])
        heap.append((-int(sums[0] - sums[-1]), at, sums, [[i] for i in run] + [[] for _ in range(k - len(run))]))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a, x, members = heapq.heappop(heap)
        _, b, y, others = heapq.heappop(heap)
        total = x + y[::-1]
        joined = [p + q for p, q in zip(members, reversed(others))]
        rank = np.argsort(-total, kind="stable")
        heapq.heappush(heap, (-int(total[rank[0]] - total[rank[-1]]), min(a, b), total[rank], [joined[i] for i in rank]))
    return heap[0][3] if heap else []


def pack_group(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity``; their number rises until none exceeds it."""
    k = -(-sum(sizes) // capacity)
    while True:
        windows = difference(sizes, k) if k else []
        if all(sum(sizes[i] for i in w) <= capacity for w in windows):
            return [w for w in windows if w]
        k += 1


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    full = n - n % capacity
    piece = max(1, int(capacity * PIECE))
    return ([(s, capacity) for s in range(0, full, capacity)]
            + [(s, min(piece, n - s)) for s in range(full, n, piece)])


def pack(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024,
         end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """One row per piece: (id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids])."""
    schema = f"{id_col} long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"][:8 if with_ids else 7]

    def run(batches):
        encode = bpe_encoder(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 33
        held: list[tuple] = []

        def rows(windows):
            nonlocal sequence
            out = []
            for window in windows:
                offset = 0
                for piece in window:
                    out.append((*piece[:5], sequence, offset, np.frombuffer(piece[5], dtype="<u4"))[:len(names)])
                    offset += piece[2]
                sequence += 1
            columns = list(zip(*out)) or [()] * len(names)
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        def flush():
            packed = pack_group([p[2] for p in held], capacity)
            return rows([[held[i] for i in w] for w in packed])

        for batch in batches:
            whole = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                n = len(ids) // 4
                for start, length in cuts(n, capacity):
                    part = ids[4 * start:4 * (start + length)]
                    piece = (key, start, length, zlib.crc32(part), n, part if with_ids else b"")
                    if length == capacity:
                        whole.append([piece])
                    else:
                        held.append(piece)
                    if len(held) == GROUP:
                        yield flush()
                        held = []
                if len(whole) >= 4096:
                    yield rows(whole)
                    whole = []
            yield rows(whole)
        yield flush()

    return df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, schema + (", ids array<int>" if with_ids else ""))


def digests(packed: DataFrame) -> DataFrame:
    """The packed rows with length and CRC computed from their ids, in place of the ids."""
    at = {n: i for i, n in enumerate(packed.columns)}
    names = [n for n in at if n != "ids"]

    def run(batches):
        for batch in batches:
            ids = batch.column(at["ids"])
            ends = ids.offsets.to_numpy()
            held = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), dtype="<u4")
            columns = list(batch.columns)
            columns[at["length"]] = pa.array(np.diff(ends), pa.int64())
            columns[at["ids_crc32"]] = pa.array([zlib.crc32(held[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.int64())
            yield pa.RecordBatch.from_arrays([columns[at[n]] for n in names], names=names)

    return packed.mapInArrow(run, T.StructType([packed.schema[n] for n in names]))
