"""Vectorised word and shingle hashing over Arrow string columns.

A *word* is a maximal run of characters other than space and U+0009..U+000D
(``[^\\x20\\x09-\\x0D]+``). UTF-8 never uses those byte values inside another
character, so words are found on the bytes of an Arrow column without decoding.

Word hashes are 64-bit polynomial hashes over a table of random byte values,
taken from prefix sums (so the cost is a few numpy passes per byte), then mixed.
Equal words always have equal hashes; different words collide with a
probability of about 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer document forms a block of its own. A byte takes
#: some 40 in the arrays of a pass, and 32 in the powers that a worker keeps.
BLOCK_BYTES = 1 << 18
#: Bytes whose words are hashed at once, few enough for a processor's cache.
_PART_BYTES = 1 << 15

_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
#: Separators of bare words: white space and all ASCII characters but letters and digits.
BARE = np.array([not (chr(b).isalnum() or b >= 128) for b in range(256)])
_TABLES = {False: _BYTES, True: _BYTES[_LOWER]}
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, dtype=np.uint64), _INVERSE: np.ones(1, dtype=np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    have = _powers[base]
    if len(have) < n:
        grown = np.full(max(n, 2 * len(have)), base, dtype=np.uint64)
        grown[0] = 1
        _powers[base] = have = np.cumprod(grown, dtype=np.uint64)
    return have[:n]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if offsets is None or n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(n + 1, dtype=np.int64)
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


class Words:
    """The words of consecutive documents: hash and byte range of each word.

    ``first`` and ``offsets`` have n + 1 entries: document d owns words first[d] ..
    first[d+1] and bytes offsets[d] .. offsets[d+1].
    """

    __slots__ = ("data", "offsets", "starts", "ends", "first", "hashes")

    def __init__(self, data, offsets, starts, ends, first, hashes):
        self.data, self.offsets, self.starts, self.ends = data, offsets, starts, ends
        self.first, self.hashes = first, hashes

    def __len__(self) -> int:
        return len(self.first) - 1


def split_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False, space: np.ndarray = _SPACE) -> Words:
    """Find and hash the words of documents that lie back to back in ``data``;
    ``space`` marks the bytes that separate words."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return Words(data, offsets, none, none, np.zeros(len(offsets), dtype=np.int64), np.zeros(0, dtype=np.uint64))
    blank = space[data]
    inside = ~blank
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = offsets[(offsets > 0) & (offsets < n)]
    begins[cut] = inside[cut]
    stops = inside
    stops[:-1] &= begins[1:] | blank[1:]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    hashes = np.empty(len(starts), dtype=np.uint64)
    table, a = _TABLES[lower], 0
    while a < len(starts):  # parts of bounded size, cut between words
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + _PART_BYTES, side="right")))
        lo, hi = int(starts[a]), int(ends[b - 1])
        run = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(table[data[lo:hi]] * powers(_BASE, hi - lo), out=run[1:])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        hashes[a:b] = mix64((run[e] - run[s]) * powers(_INVERSE, hi - lo)[s])
        a = b
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets), hashes)


def blocks(column: pa.Array, lower: bool = False, space: np.ndarray = _SPACE) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) of consecutive rows with about BLOCK_BYTES of text."""
    data, offsets = column_bytes(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, side="right")) - 1)
        end = min(end, rows)
        part = offsets[row:end + 1]
        yield row, end, split_words(data[part[0]:part[-1]], part - part[0], lower, space)
        row = end


def prefix_hashes(words: Words, size: int, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers, hashes of their first ``size`` bytes) of all words of more bytes."""
    longer = np.flatnonzero(words.ends - words.starts > size)
    at, table, power = words.starts[longer], _TABLES[lower], powers(_BASE, size)
    total = np.full(len(longer), size, dtype=np.uint64)
    for i in range(size):
        total += table[words.data[at + i]] * power[i]
    return longer, mix64(total * _U(0x9E3779B97F4A7C15))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive entries (document edges are the caller's)."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, dtype=np.uint64)
    run = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * powers(_BASE, n), out=run[1:])
    return mix64((run[size:] - run[:-size]) * powers(_INVERSE, n + 1)[:n - size + 1] + _U(size))


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of one document's k-word shingles.

    With fewer than k words the whole sequence counts as one shingle; without
    words the set is empty.
    """
    if len(hashes) == 0:
        return hashes
    return np.unique(window_hashes(hashes, min(k, len(hashes))))
