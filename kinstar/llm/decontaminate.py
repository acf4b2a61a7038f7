"""Benchmark decontamination by greedy string tiling.

1. *Seeds*: every run of ``SEED`` words of a benchmark item, hashed. Documents
   are joined with the items on equal seeds while they are read; the seeds of a
   block of items (at most ``ITEM_WORDS`` words) are held sorted in each task, and
   a benchmark of more words is taken block by block, so what a task holds is
   bounded whatever the benchmark's size.
2. *Tiles*: for each document and item with a shared seed, the longest match of
   unmarked words on both sides is marked again and again, until no match of
   ``SEED`` words is left. Matches are found by running Karp-Rabin (runs of equal
   running hashes, verified word by word) and wait in a heap by length; what is left
   of a match whose words were marked meanwhile goes back by its own length.
3. An item is leaked if the tiles cover at least ``threshold`` of its words. As
   tiles may lie in any order, reordered passages are caught.

Items of fewer than ``SEED`` words are matched as a whole.

Words are runs of letters and digits in lower case, so punctuation does not
matter. Texts are taken whole; a document costs its seeds' occurrences times the item's
length, so that long texts of one repeated word end in seconds, too. Of equally long
matches the first in the document, then in the item, is marked. Defined cases: null or blank texts and
items match nothing; items that repeat an id or a text are items of their own;
a null document id stays null; an empty benchmark leaks nowhere; extra columns
are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinstar.llm.words import BARE, blocks, window_hashes

SEED = 5
#: Words of benchmark items held by a task at once (16 bytes each).
ITEM_WORDS = 2_000_000

Item = tuple[int, np.ndarray]


def _matches(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(length, start in doc, start in item) of all maximal matches of ``least`` words or more: runs of
    consecutive windows whose running hashes are equal. Goes through the item's windows one by one, with
    all windows of the document that occur in the item at once."""
    hd, hi = window_hashes(doc, least), window_hashes(item, least)
    hits = np.flatnonzero(np.isin(hd, hi))
    found: list[tuple[int, int, int]] = []
    if not len(hits):
        return found
    here, joined = hd[hits], np.zeros(len(hits), dtype=bool)
    joined[1:] = hits[1:] == hits[:-1] + 1
    run = np.zeros(len(hits), dtype=np.int64)  # windows of the match that ends in the last item window
    for p in range(len(hi) + 1):
        equal = here == hi[p] if p < len(hi) else np.zeros(len(hits), dtype=bool)
        on = np.zeros(len(hits), dtype=bool)
        on[:-1] = joined[1:] & equal[1:]
        ended = np.flatnonzero((run > 0) & ~on)
        found += [(int(run[k]) + least - 1, int(hits[k] - run[k]) + 1, p - int(run[k])) for k in ended]
        before = np.zeros(len(hits), dtype=np.int64)
        before[1:] = np.where(joined[1:], run[:-1], 0)
        run = np.where(equal, before + 1, 0)
    return found


def tiles(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of word hashes: (start in doc, start in item, length).

    The longest match of unmarked words is marked, again and again; of equally long ones the first
    in the document, then in the item. What marked words leave of a match waits for its turn by its
    own length.
    """
    found: list[tuple[int, int, int]] = []
    free_d, free_i = np.ones(len(doc), dtype=bool), np.ones(len(item), dtype=bool)
    left = len(item)
    waiting = [(-n, d, p) for n, d, p in _matches(doc, item, least) if (doc[d:d + n] == item[p:p + n]).all()]
    heapq.heapify(waiting)
    while waiting and left >= least:
        n, d, p = heapq.heappop(waiting)
        n = -n
        free = free_d[d:d + n] & free_i[p:p + n]
        if free.all():
            free_d[d:d + n] = free_i[p:p + n] = False
            found.append((d, p, n))
            left -= n
        elif free.any():
            edge = np.flatnonzero(np.diff(np.concatenate(([0], free.view(np.int8), [0]))))
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
                if b - a >= least:
                    heapq.heappush(waiting, (a - b, d + a, p + a))
    return found


def _items(benchmark: DataFrame, id_col: str, text_col: str, words: int):
    """Blocks of items as (id, word hashes) with at most ``words`` words (or one item)."""
    def hashed(batches):
        for batch in batches:
            for row, end, w in blocks(batch.column(1), lower=True, space=BARE):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row),
                     pa.array([w.hashes[a:b].tobytes() for a, b in zip(w.first, w.first[1:])], pa.binary())], names=["id", "words"])

    frame = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        hashed, "id long, words binary").where("id is not null and octet_length(words) > 0")
    held, size = [], 0
    for row in frame.toLocalIterator():
        item = (row["id"], np.frombuffer(row["words"], dtype=np.uint64))
        if held and size + len(item[1]) > words:
            yield held
            held, size = [], 0
        held.append(item)
        size += len(item[1])
    if held:
        yield held


class Matcher:
    """The seeds of a block of items, and the search for the items in texts."""

    def __init__(self, items: list[Item], threshold: float, seed: int):
        self.items, self.threshold, self.seed = items, threshold, seed
        # seeds of all items, sorted by hash; a short item is its own seed
        parts = [window_hashes(w, min(seed, len(w))) for _, w in items]
        seeds = np.concatenate(parts)
        owners = np.repeat(np.arange(len(items)), [len(p) for p in parts])
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.owners = seeds[order], owners[order]
        self.sizes = sorted({min(seed, len(w)) for _, w in items})

    def leaks(self, texts: pa.Array) -> Iterator[tuple[int, int, int, list[tuple[int, int, int]]]]:
        """(row, item id, words of the item, tiles) of every leak, by row."""
        for row, end, words in blocks(texts, lower=True, space=BARE):
            near: dict[int, set[int]] = {}
            for size in self.sizes:
                hashes = window_hashes(words.hashes, size)
                at = np.searchsorted(self.seeds, hashes)
                at[at == len(self.seeds)] = 0
                for p in np.flatnonzero(self.seeds[at] == hashes):
                    d = int(np.searchsorted(words.first, p, side="right")) - 1
                    if p + size <= words.first[d + 1]:
                        last = int(np.searchsorted(self.seeds, hashes[p], side="right"))
                        near.setdefault(d, set()).update(self.owners[at[p]:last].tolist())
            for d in sorted(near):
                doc = words.hashes[words.first[d]:words.first[d + 1]]
                for i in sorted(near[d]):
                    key, item = self.items[i]
                    marked = tiles(doc, item, min(self.seed, len(item)))
                    if sum(n for _, _, n in marked) >= self.threshold * len(item):
                        yield row + d, key, len(item), marked


_LEAKS = ("doc_id long, item_id long, item_words long, covered_words long, n_tiles long, "
          "tiles array<struct<doc_start: long, item_start: long, length: long>>")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text", threshold: float = 0.5, seed: int = SEED) -> DataFrame:
    """One row per document and benchmark item whose words the document's tiles cover by the threshold."""
    def listed(matcher: Matcher):
        def run(batches):
            for batch in batches:
                out: list[list] = [[], [], [], [], [], []]
                for row, key, n, marked in matcher.leaks(batch.column(1)):
                    for column, value in zip(out, (
                            batch.column(0)[row].as_py(), key, n, sum(m[2] for m in marked), len(marked),
                            [{"doc_start": a, "item_start": b, "length": m} for a, b, m in marked])):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(out, [pa.int64()] * 5 + [pa.list_(pa.struct(
                        [("doc_start", pa.int64()), ("item_start", pa.int64()), ("length", pa.int64())]))])],
                    names=["doc_id", "item_id", "item_words", "covered_words", "n_tiles", "tiles"])
        return run

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = None
    for items in _items(benchmark, item_col, item_text_col, ITEM_WORDS):
        part = texts.mapInArrow(listed(Matcher(items, threshold, seed)), _LEAKS)
        found = part if found is None else found.union(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], _LEAKS)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", threshold: float = 0.5, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` that leak no item: a filter while reading, without a join."""
    place = docs.columns.index(text_col)

    def clean(matcher: Matcher):
        def run(batches):
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[row for row, *_ in matcher.leaks(batch.column(place))]] = False
                yield batch.filter(pa.array(keep))
        return run

    for items in _items(benchmark, item_col, item_text_col, ITEM_WORDS):
        docs = docs.mapInArrow(clean(Matcher(items, threshold, seed)), docs.schema)
    return docs
