"""CRC-32 of many byte spans at once, from a position table.

A CRC is linear but for a constant: the CRC of a span is a constant of its length
XOR the contributions of its bytes, and what a byte contributes depends on its value
and on its distance from the span's end alone. ``_TABLE`` holds the contributions for
distances below ``REACH``; they are looked up for all bytes of all spans and reduced
by ``np.bitwise_xor.reduceat``. A longer span is cut, from its end, into blocks of
``REACH`` bytes, whose sums are moved to their distance from the end (``advance``) and
reduced once more.
"""

from __future__ import annotations

import numpy as np

#: Distances from the end of a span that the table covers.
REACH = 128
#: Bytes of spans handled at once.
_PART = 1 << 16
_U = np.uint32

# fixed value: the reflected polynomial of the usual CRC-32
_POLYNOMIAL = _U(0xEDB88320)


def _step_table() -> np.ndarray:
    """What the lowest byte of a remainder turns into when one more byte follows."""
    v = np.arange(256, dtype=_U)
    for _ in range(8):
        v = np.where(v & _U(1), (v >> _U(1)) ^ _POLYNOMIAL, v >> _U(1))
    return v


_STEP = _step_table()


def _position_table() -> np.ndarray:
    rows = [_STEP]
    for _ in range(REACH - 1):
        rows.append((rows[-1] >> _U(8)) ^ _STEP[rows[-1] & _U(255)])
    return np.concatenate(rows)  # at distance * 256 + byte


_TABLE = _position_table()


def _moves() -> list[np.ndarray]:
    """Per power of two, the images of a remainder's four bytes (each 0..255) behind that many zero bytes."""
    byte = np.arange(256, dtype=_U)
    values = np.stack([byte << _U(8 * i) for i in range(4)])
    moved = [(values >> _U(8)) ^ _STEP[values & _U(255)]]
    for _ in range(39):
        moved.append(_moved(_moved(values, moved[-1]), moved[-1]))
    return moved


def _moved(v: np.ndarray, table: np.ndarray) -> np.ndarray:
    out = table[0][v & _U(255)]
    for i in range(1, 4):
        out = out ^ table[i][(v >> _U(8 * i)) & _U(255)]
    return out


_MOVES = _moves()


def advance(remainders: np.ndarray, distances: np.ndarray) -> np.ndarray:
    """Remainders with ``distances`` zero bytes behind them."""
    out = remainders.astype(_U)
    for bit in range(int(distances.max(initial=0)).bit_length()):
        at = np.flatnonzero((distances >> bit) & 1)
        out[at] = _moved(out[at], _MOVES[bit])
    return out


def _length_constants(lengths: np.ndarray) -> np.ndarray:
    """The CRC of so many zero bytes."""
    each, back = np.unique(lengths, return_inverse=True)
    ones = np.full(len(each), 0xFFFFFFFF, dtype=_U)
    return (advance(ones, each) ^ _U(0xFFFFFFFF))[back]


def _sums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XOR of the contributions of non-empty spans of at most REACH bytes."""
    out = np.empty(len(starts), dtype=_U)
    ends = np.cumsum(lengths)
    place = np.arange(_PART + REACH, dtype=np.int32)
    a = 0
    while a < len(starts):
        done = int(ends[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + _PART, side="right")))
        n, first = lengths[a:b], ends[a:b] - lengths[a:b] - done
        k = place[:int(ends[b - 1]) - done]
        low = int(starts[a:b].min())
        near = data[low:int((starts[a:b] + n).max())]
        kind = np.int32 if len(near) < 1 << 31 else np.int64
        byte = near.take(np.repeat((starts[a:b] - low - first).astype(kind), n) + k)
        # table places: (last - k) * 256 + byte
        at = np.repeat(((first + n - 1) << 8).astype(np.int32), n)
        at -= k << 8
        at += byte
        out[a:b] = np.bitwise_xor.reduceat(_TABLE.take(at), first)
        a = b
    return out


def crc32_of_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of data[start:end] of every span; spans may overlap and may be empty."""
    starts, lengths = np.asarray(starts, dtype=np.int64), np.asarray(ends, dtype=np.int64) - np.asarray(starts, dtype=np.int64)
    out = _length_constants(lengths)
    short = np.flatnonzero((lengths > 0) & (lengths <= REACH))
    out[short] ^= _sums(data, starts[short], lengths[short])
    long = np.flatnonzero(lengths > REACH)
    if len(long):
        blocks = -(-lengths[long] // REACH)
        of, first = np.repeat(long, blocks), np.cumsum(blocks) - blocks
        behind = (np.repeat(first + blocks, blocks) - 1 - np.arange(len(of))) * REACH  # bytes between a block and its span's end
        stop = starts[of] + lengths[of] - behind
        begin = np.maximum(starts[of], stop - REACH)
        out[long] ^= np.bitwise_xor.reduceat(advance(_sums(data, begin, stop - begin), behind), first)
    return out
