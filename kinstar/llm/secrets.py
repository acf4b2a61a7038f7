"""Secret scans: fixed patterns, and a linear-chain conditional random field.

*Patterns* (``base_spans``): assignments to a secret's name, access key ids, and
long hexadecimal runs, leftmost and without overlap per kind.

*Field*: texts are read as tokens (runs of Latin letters, digits and ``_+/-``, and
runs of other characters outside ASCII), each tagged B (a secret begins), I (inside) or O
(outside). Every token may be B; I needs a B or I before it that is joined to it
without white space. So the chain falls into segments, the runs of joined tokens,
and decoding each by Viterbi gives the best path of the whole text. Potentials
are linear in features of the token's shape, length and character mix, the words
and signs around it, and the file it is in (see ``_features``), plus tag
transitions. ``Gains`` bounds from the weights what B or I can gain over O at a token:
shape, length, character mix, neighbouring signs, place, file and whether something
is assigned are taken in numpy for the tokens of a block of texts at once, and what
needs the token's letters or the words around it counts at its most. Where no token of
a segment can gain, O is the best path and the other features need not be built. The
bound is exact: the spans are those of decoding every segment.

It is trained by stochastic gradient on at most ``SAMPLE`` documents: up to half
are documents with a match of the patterns, found over the whole table, and as
many are others (those with the smallest hashes of id and text; repeated rows
count once). Of each at most ``PER_DOC`` segments with a match and ``OTHERS``
without one of either sort, codes and plain words, are taken by hash. The tokens
of the patterns' values, without the names before them, are B and I. To carry
over to what the patterns do not name, the features that restate the patterns
(names of secrets, length, alphabet) are left out of every fourth example, and all of
the token's own features of every other fourth one, and each match is learned with
other values in its place, too (``_VALUES``).

Spans of the field are added where they meet no span of the patterns.

Texts are read whole, in blocks of ``BLOCK`` characters (a longer text is a block of its
own), so a task's memory grows with its longest text only.

Defined cases: null and empty texts have no spans; a table without any match
gives no field, then the patterns stand alone; repeated rows are scanned each;
extra columns are kept by ``redact`` and ignored by ``scan``.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinstar.llm.graph import stored

KINDS = ("assign", "access", "hex", "crf")
# fixed values: the base patterns and their least lengths
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # 18 characters or more
_HEX = re.compile(r"[0-9a-f]{16,}")
_ASSIGN_LEAST = 12

#: Bounds of the training sample: documents, segments of each with a match, others of either sort, tokens of a segment.
SAMPLE, PER_DOC, OTHERS, LONGEST = 4000, 40, 6, 16
#: Alphabets of the values that vary the matches in training: the first anywhere, the others where a value is assigned.
_ALPHA = "abcdefghijkmnpqrstuvwxyz"
_VALUES = (_ALPHA + _ALPHA.upper() + "0123456789" * 2, _ALPHA + "---", _ALPHA.upper(), _ALPHA + "0123456789" + "!@#$%&*" * 2)
_EPOCHS, _RATE, _DECAY = 12, 0.2, 1e-4
_TAGS = 3
_B, _I, _O = range(_TAGS)

#: Characters of text whose tokens are bounded at once.
BLOCK = 1 << 20

_TOKEN = re.compile(r"[A-Za-z0-9_+/\u00c0-\u024f-]+|[^\x00-\x7f\u00c0-\u024f\s]+")
#: Letters and digits to a, A and 0.
_SHAPE = str.maketrans({c: "a" if c.islower() else "A" if c.isupper() else "0"
                        for c in map(chr, [*range(128), *range(0xC0, 0x250)]) if c.islower() or c.isupper() or c.isdigit()})
_SPACE = re.compile(r"\s")
_CODE = re.compile(r"[0-9]|[a-z][A-Z]")
_GAP = re.compile(r"""["']?\x20*[=:]\x20*["']?$""")
_WORD = re.compile(r"[A-Za-z]+")
_NAMED = re.compile(r"pass|pwd|secret|token|key|cred|auth", re.I)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns' matches, by start, then kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= _ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def segments(text: str) -> list[list[tuple[int, int]]]:
    """All tokens, in runs without white space between them."""
    out: list[list[tuple[int, int]]] = []
    end = -1
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        if a == end or (end >= 0 and not _SPACE.search(text, end, a)):
            out[-1].append((a, b))
        else:
            out.append([(a, b)])
        end = b
    return out


def _file_features(text: str) -> list[str]:
    n = max(1, len(text))
    signs = sum(text.count(c) for c in "={};")
    return [f"file:signs{min(3, signs * 400 // n)}", f"file:lines{min(3, text.count(chr(10)) * 200 // n)}",
            f"file:long{len(text) > 2000}"]


def _own_features(token: str) -> list[str]:
    """Of the token alone; + marks those that restate the patterns, = the others."""
    entropy = -sum(p * np.log2(p) for p in (n / len(token) for n in Counter(token).values()))
    return [*_shape_features(token), f"=entropy{int(entropy)}", f"+hex{re.fullmatch('[0-9a-f]+', token) is not None}"]


def _shape_features(token: str) -> list[str]:
    """Those of :func:`_own_features` that stay when letters are exchanged for others of their case."""
    token = token.translate(_SHAPE)
    shape = re.sub("a+", "a", re.sub("A+", "A", re.sub("0+", "0", token)))
    digits = sum(map(str.isdigit, token))
    return [f"=mixed{digits > 0 and any(map(str.isalpha, token))}", f"=digits{digits * 4 // len(token)}", f"+shape:{shape[:6]}", f"=changes{min(len(shape), 12) // 2}", f"=signs{min(3, sum(token.count(c) for c in '+-/'))}",
            f"+number{token.isdigit()}", f"+upper{re.fullmatch('[A-Z0-9]+', token) is not None}",
            f"=short{min(len(token), 8)}", f"+length{min(len(token), 48) // 4}"]


def _edge_features(before: str, after: str) -> list[str]:
    """Of the characters next to a token (empty at an end of the text); all white space is alike."""
    signs = [" " if c.isspace() else c if c and not c.isalnum() else "x" for c in (before, after)]
    return [f"quoted{before in (chr(34), chr(39))}", f"before:{signs[0]}", f"after:{signs[1]}"]


def _features(text: str, run: list[tuple[int, int]], of_file: list[str]) -> list[list[str]]:
    """Feature names of every token of a segment."""
    out = []
    for i, (a, b) in enumerate(run):
        before, after = text[max(0, a - 40):a], text[b:b + 20]
        words = _WORD.findall(before)
        out.append([
            "bias", *_own_features(text[a:b]), *_edge_features(before[-1:], after[:1]),
            f"+name:{words[-1].lower()[:12] if words else ''}", *_place_features(i, before, words, after), *of_file])
    return out


def _name_code(name: str) -> int:
    """A number for a word of up to 12 Latin letters in lower case."""
    code = 0
    for c in name:
        code = code * 27 + ord(c) - 96
    return code


def _place_features(i: int, before: str, words: list[str], after: str) -> tuple[str, ...]:
    """Of a token's place in its segment, and of what stands before and behind it."""
    assigned = _GAP.search(before) is not None
    named = assigned and _NAMED.search(" ".join(words[-2:])) is not None
    following = _WORD.search(after)
    return f"pos{min(i, 2)}", f"assigned{assigned}", f"named{named}", f"next:{following is not None and following[0].islower()}"


@dataclass
class Field:
    """Weights by feature (a row of one weight per tag), and transition weights."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)
    moves: np.ndarray = field(default_factory=lambda: np.zeros((_TAGS, _TAGS)))
    _gains: Gains | None = field(default=None, repr=False, compare=False)

    def potentials(self, features: list[list[str]]) -> np.ndarray:
        none = np.zeros(_TAGS)
        p = np.array([sum((self.weights.get(f, none) for f in names), none) for names in features])
        p[0, _I] = -np.inf  # nothing to continue
        return p

    def gains(self) -> Gains:
        if self._gains is None:
            self._gains = Gains(self)
        return self._gains

    def viterbi(self, features: list[list[str]]) -> list[int]:
        return self.decode(self.potentials(features))

    def decode(self, p: np.ndarray) -> list[int]:
        """The best tags for given potentials."""
        moves = _allowed(self.moves)
        score, back = p[0], []
        for row in p[1:]:
            step = score[:, None] + moves
            back.append(step.argmax(axis=0))
            score = step.max(axis=0) + row
        tags = [int(score.argmax())]
        for best in reversed(back):
            tags.append(int(best[tags[-1]]))
        return tags[::-1]


_SIGN, _LATIN, _OTHER, _BLANK = range(4)


def _groups() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its sort (the tokens are runs of _LATIN or of _OTHER), and whether tokens with it are odd
    (neither letter, digit nor sign of _LATIN, or a digit of _OTHER)."""
    group, odd = np.full(0x110000, _OTHER, dtype=np.uint8), np.zeros(0x110000, dtype=bool)
    group[:128] = _SIGN
    for c in range(0x3100):
        if _SPACE.match(chr(c)):
            group[c] = _BLANK
        elif re.match(r"[A-Za-z0-9_+/\u00c0-\u024f-]", chr(c)):
            group[c] = _LATIN
    for c in range(0x20000):
        odd[c] = (c not in _SYMBOLS if group[c] == _LATIN else group[c] == _OTHER and chr(c).isdigit())
    return group, odd


#: Letters and digits of a shape, and the signs in tokens, as numbers.
_SYMBOLS = {**{k: "aA0".index(v) + 1 for k, v in ((k, chr(v) if isinstance(v, int) else v) for k, v in _SHAPE.items())},
            **{ord(c): i for i, c in enumerate("_+/-", 4)}}
_GROUP, _ODD = _groups()
_SYMBOL = np.zeros(0x251, dtype=np.int64)
_SYMBOL[list(_SYMBOLS)] = list(_SYMBOLS.values())


class Gains:
    """What B and I at a token add to a path over O there: bounds for all tokens of a block of
    texts, and exact potentials, from kept sums, for the tokens of the segments left open."""

    #: Tokens whose own features' sums are kept.
    KEPT = 200_000
    _LONG, _NON_ASCII, _EDGE = 49, 128, 129

    def __init__(self, model: Field):
        self.model, self.weights = model, model.weights
        self.kept: dict[str, np.ndarray] = {}
        self.edges: dict[tuple[str, str], np.ndarray] = {}
        moves = _allowed(model.moves) - model.moves[_O, _O]
        self.enter = np.maximum(moves.max(axis=0), 0)[:_O]  # the first token of a segment is entered without a move
        self.leave = max(0.0, moves[:, _O].max())
        gain, top = self.gain, self.top
        self.free = top("+name:") + np.maximum(gain("next:True"), gain("next:False"))
        self.following = np.array([gain("next:False"), gain("next:True")])
        names = sorted((_name_code(f[6:]), *gain(f)) for f in self.weights if re.fullmatch(r"\+name:[a-z]{0,12}", f))
        self.name_codes = np.array([n[0] for n in names] + [2 ** 62], dtype=np.int64)
        self.name_gains = np.array([n[1:] for n in names] + [(0.0, 0.0)])
        self.place_sums: dict[tuple, np.ndarray] = {}
        self.place = np.array([[gain(f"pos{i}") + gain(f"assigned{y}") + (np.maximum(gain("namedTrue"), gain("namedFalse")) if y else gain("namedFalse"))
                                for y in (False, True)] for i in range(3)]).reshape(6, 2)
        entropies = [gain(f"=entropy{e}") for e in range(7)]
        self.length = np.array([gain(f"=short{min(n, 8)}") + gain(f"+length{min(n, 48) // 4}")
                                + (np.max(entropies[:n.bit_length()], axis=0) if 0 < n < self._LONG else top("=entropy"))
                                for n in range(self._LONG + 1)])
        hexes = gain("+hexFalse"), np.maximum(gain("+hexFalse"), gain("+hexTrue"))
        mix = np.zeros((5, 7, 4, 2, 2, 2, 2, 2))
        for i in range(5):
            mix[i] += gain(f"=digits{i}")
        for i in range(7):
            mix[:, i] += gain(f"=changes{i}")
        for i in range(4):
            mix[:, :, i] += gain(f"=signs{i}")
        for i in range(2):
            mix[:, :, :, i] += gain(f"=mixed{bool(i)}")
            mix[:, :, :, :, i] += gain(f"+number{bool(i)}")
            mix[:, :, :, :, :, i] += gain(f"+upper{bool(i)}")
            mix[:, :, :, :, :, :, i] += hexes[i]
        self.mix = mix.reshape(-1, 2)
        self.shape, self.other_shape = np.zeros((8 ** 6, 2)), np.zeros(2)
        for f in self.weights:
            if f.startswith("+shape:"):
                at = [" aA0_+/-".find(c) for c in f[7:]]
                if at and min(at) > 0:
                    self.shape[sum(k << 3 * i for i, k in enumerate(at))] = gain(f)
                else:
                    self.other_shape = np.maximum(self.other_shape, gain(f))
        self.beside = (self._beside("before:", quoted=True)[:, None] + self._beside("after:", quoted=False)[None, :]).reshape(-1, 2)

    def gain(self, name: str) -> np.ndarray:
        w = self.weights.get(name)
        return np.zeros(2) if w is None else (w - w[_O])[:_O]

    def top(self, group: str) -> np.ndarray:
        """The most of any feature of a group; unknown features weigh 0."""
        return np.max([np.zeros(2), *(self.gain(f) for f in self.weights if f.startswith(group))], axis=0)

    def _beside(self, name: str, quoted: bool) -> np.ndarray:
        """By the character beside a token: ASCII, any other, none."""
        out = np.zeros((130, 2))
        for c in map(chr, range(128)):
            out[ord(c)] = self.gain(name + (" " if c.isspace() else "x" if c.isalnum() else c))
        out[self._NON_ASCII] = np.max([out[32], out[48], *(self.gain(f) for f in self.weights if f.startswith(name) and f[-1:] > "\x7f"), np.zeros(2)], axis=0)
        out[self._EDGE] = out[48]
        if quoted:
            out += self.gain("quotedFalse")
            for c in (34, 39):
                out[c] += self.gain("quotedTrue") - self.gain("quotedFalse")
        return out

    def total(self, names: list[str]) -> np.ndarray:
        none = np.zeros(_TAGS)
        return sum((self.weights.get(f, none) for f in names), none)

    def open_runs(self, texts: list[str], files: list[np.ndarray]) -> list[tuple[int, list[tuple[int, int]]]]:
        """(text, tokens) of the segments in which something may gain; ``files``: the sums of the texts' file features."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        if not len(codes):
            return []
        begin = np.cumsum(sizes) - sizes
        group = _GROUP[codes]
        inside = (group == _LATIN) | (group == _OTHER)
        first = inside.copy()
        first[1:] &= group[1:] != group[:-1]
        cut = begin[(begin > 0) & (begin < len(codes))]
        first[cut] = inside[cut]
        starts = np.flatnonzero(first)
        if not len(starts):
            return []
        chars = np.flatnonzero(inside)
        at = np.searchsorted(chars, starts)  # of the tokens among the characters of tokens
        n = np.diff(np.append(at, len(chars)))
        ends = starts + n
        of = np.searchsorted(begin, starts, side="right") - 1
        # segments: white space or another text between tokens
        blanks = np.cumsum(group == _BLANK, dtype=np.int32)[starts]
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (blanks[1:] != blanks[:-1]) | (of[1:] != of[:-1])
        runs = np.flatnonzero(new)
        many = np.diff(np.append(runs, len(starts)))
        gains = (np.array(files) - np.array(files)[:, [_O]])[:, :_O][of] + self.free
        gains += self._own(codes, chars, at, n, group[starts] == _OTHER)
        # what is beside, the place in the segment, and assignments
        to = np.minimum(codes, self._NON_ASCII).astype(np.int64)
        last = begin[of] + sizes[of]
        before = np.where(starts > begin[of], to[starts - 1], self._EDGE)
        after = np.where(ends < last, to[np.minimum(ends, len(codes) - 1)], self._EDGE)
        gains += self.beside.take(before * 130 + after, axis=0)
        place = np.minimum(np.arange(len(starts)) - np.repeat(runs, many), 2)
        gains += self.place.take(2 * place + _assigned(to, starts, begin[of]), axis=0)
        single = np.repeat(many == 1, many)
        most = np.where(single, gains[:, _B], (gains + self.enter).max(axis=1) + self.leave)
        # the sums' rounding does not decide
        may = np.repeat(np.maximum.reduceat(most, runs) > -1e-6, many)
        if may.any():
            # the words around the tokens of the segments that are left
            at = np.flatnonzero(may)
            some = gains[at] - self.free + self._around(codes, starts[at], ends[at], begin[of[at]], last[at])
            most[:] = -np.inf
            most[at] = np.where(single[at], some[:, _B], (some + self.enter).max(axis=1) + self.leave)
        chosen = np.flatnonzero(np.maximum.reduceat(most, runs) > -1e-6)
        out = []
        for r in chosen.tolist():
            a, b = int(runs[r]), int(runs[r] + many[r])
            d = int(of[a])
            out.append((d, list(zip((starts[a:b] - begin[d]).tolist(), (ends[a:b] - begin[d]).tolist()))))
        return out

    def _around(self, codes, starts, ends, begin, last) -> np.ndarray:
        """What the word before (within 40 characters of its text) and the case of the word behind
        (within 20) add, exactly."""
        low = codes | 32
        letter = (codes < 128) & (low >= 97) & (low <= 122)
        place = np.arange(len(codes))
        solid = np.maximum.accumulate(np.where(letter, place, -1))
        gap = np.maximum.accumulate(np.where(letter, -1, place))
        front = np.maximum(begin, starts - 40)
        p = np.where(starts > front, solid[starts - 1], -1)
        first = np.maximum(gap[np.maximum(p, 0)] + 1, front)
        code, length = np.zeros(len(starts), dtype=np.int64), np.where(p >= front, np.minimum(p + 1 - first, 12), 0)
        for i in range(12):
            more = np.flatnonzero(length > i)
            code[more] = code[more] * 27 + (low[first[more] + i].astype(np.int64) - 96)
        at = np.searchsorted(self.name_codes, code)
        out = np.where((self.name_codes[at] == code)[:, None], self.name_gains[at], 0.0)
        end = np.minimum(ends + 20, last)
        near = np.minimum.accumulate(np.where(letter, place, len(codes))[::-1])[::-1]
        q = np.where(ends < end, near[np.minimum(ends, len(codes) - 1)], len(codes))
        found = q < end
        q = np.where(found, q, 0)
        off = np.minimum.accumulate(np.where(letter, len(codes), place)[::-1])[::-1]
        uppers = np.concatenate(([0], np.cumsum(letter & (codes < 97), dtype=np.int64)))
        lower = found & (uppers[np.minimum(off[q], end)] == uppers[q])
        return out + self.following[lower.astype(np.int64)]

    def _own(self, codes, chars, at, n, other) -> np.ndarray:
        """Bounds of the tokens' own features; ``at``: their first characters among ``chars``."""
        inside = codes[chars]
        symbol = _SYMBOL[np.minimum(inside, 0x250)]
        symbol[_GROUP[inside] == _OTHER] = 8

        def count(mark):
            return np.add.reduceat(mark, at, dtype=np.int64)

        kept = np.ones(len(chars), dtype=bool)
        kept[1:] = (symbol[1:] != symbol[:-1]) | (symbol[1:] > 3)
        kept[at] = True
        rank = np.cumsum(kept, dtype=np.int64)
        rank -= np.repeat(rank[at], n)
        digits, lowers, uppers = count(symbol == 3), count(symbol == 1), count(symbol == 2)
        signs, changes = count((symbol > 4) & (symbol < 8)), count(kept)
        shape = np.add.reduceat(np.where(kept & (rank < 6) & (symbol < 8), symbol << (3 * np.minimum(rank, 5)), 0), at)
        letters = lowers + uppers
        mix = np.stack([digits * 4 // n, np.minimum(changes, 12) // 2, np.minimum(signs, 3), (digits > 0) & (letters > 0),
                        digits == n, (uppers + digits) == n, (lowers + digits) == n])
        out = self.mix.take(np.ravel_multi_index(tuple(mix.astype(np.int64)), (5, 7, 4, 2, 2, 2, 2)), axis=0)
        out += np.where(other[:, None], self.other_shape, self.shape.take(shape, axis=0))
        out += self.length.take(np.minimum(n, self._LONG), axis=0)
        out[np.logical_or.reduceat(_ODD[inside], at)] = np.inf
        return out

    def potentials(self, text: str, run: list[tuple[int, int]], of_file: np.ndarray) -> np.ndarray:
        """As :meth:`Field.potentials` of the run's features."""
        p, none = np.empty((len(run), _TAGS)), np.zeros(_TAGS)
        for i, (a, b) in enumerate(run):
            token, before, after = text[a:b], text[max(0, a - 40):a], text[b:b + 20]
            own = self.kept.get(token)
            if own is None:
                own = self.total(["bias", *_own_features(token)])
                if len(token) < 64:
                    if len(self.kept) >= self.KEPT:
                        self.kept.clear()
                    self.kept[token] = own
            beside = self.edges.get((before[-1:], after[:1]))
            if beside is None:
                beside = self.edges[before[-1:], after[:1]] = self.total(_edge_features(before[-1:], after[:1]))
            words = _WORD.findall(before)
            p[i] = own + beside + of_file + self.weights.get(f"+name:{words[-1].lower()[:12] if words else ''}", none)
            place = _place_features(i, before, words, after)
            sums = self.place_sums.get(place)
            if sums is None:
                sums = self.place_sums[place] = self.total(list(place))
            p[i] += sums
        p[0, _I] = -np.inf
        return p

    def tags(self, p: np.ndarray) -> list[int]:
        """The best path, decoded only if some token may gain."""
        if len(p) == 1:
            return [int(p[0].argmax())]
        gains = (p - p[:, [_O]])[:, :_O] + self.enter
        return self.model.decode(p) if gains.max() + self.leave > -1e-6 else [_O] * len(p)


def _assigned(codes: np.ndarray, starts: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Whether = or : (with blanks and a quote at most between) stands before each start, within 40 characters of its text."""
    solid = np.maximum.accumulate(np.where(codes != 32, np.arange(len(codes)), -1))
    low = np.maximum(begin, starts - 40)

    def gap(end):
        p = end - 1
        quote = (p >= low) & ((codes[p] == 34) | (codes[p] == 39))
        p = p - quote
        p = np.where(p >= low, solid[p], -1)
        return (p >= low) & ((codes[p] == 61) | (codes[p] == 58))

    line = (starts > low) & (codes[starts - 1] == 10)  # the pattern may end before a line's end
    return gap(starts) | (line & gap(starts - line))


def _allowed(moves: np.ndarray) -> np.ndarray:
    moves = moves.copy()
    moves[_O, _I] = -np.inf
    return moves


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def fit(examples: list[tuple[list[list[str]], list[int]]], epochs: int = _EPOCHS) -> Field:
    """Maximise the conditional likelihood of the tags by stochastic gradient (in a fixed order)."""
    place: dict[str, int] = {}
    held = []
    for features, tags in examples:
        every = [np.array([place.setdefault(f, len(place)) for f in names], dtype=np.int64) for names in features]
        some = [np.array([place[f] for f in names if f[0] != "+"], dtype=np.int64) for names in features]
        around = [np.array([place[f] for f in names if f[0] not in "+="], dtype=np.int64) for names in features]
        held.append(((every, some, every, around), tags))
    weights, model = np.zeros((len(place), _TAGS)), Field()
    order = np.random.default_rng(7)
    for epoch in range(epochs):
        rate = _RATE / (1 + 0.3 * epoch)
        for n in order.permutation(len(held)):
            views, tags = held[n]
            rows = views[(n + epoch) % 4]
            p = np.array([weights[at].sum(axis=0) for at in rows])
            p[0, _I] = -np.inf
            if len(rows) == 1:
                chance = np.exp(p - p[0].max())
                chance /= chance.sum()
            else:
                moves = _allowed(model.moves)
                ahead = [p[0]]
                for row in p[1:]:
                    ahead.append(_log_sum(ahead[-1][:, None] + moves, 0) + row)
                behind = [np.zeros(_TAGS)]
                for row in p[:0:-1]:
                    behind.append(_log_sum(moves + (row + behind[-1])[None, :], 1))
                behind.reverse()
                total = _log_sum(ahead[-1], 0)
                chance = np.exp(np.array(ahead) + np.array(behind) - total)
            for i, at in enumerate(rows):
                step = -chance[i]
                step[tags[i]] += 1
                weights[at] += rate * (step - _DECAY * weights[at])
                if i:
                    pair = -np.exp(ahead[i - 1][:, None] + moves + (p[i] + behind[i])[None, :] - total)
                    pair[tags[i - 1], tags[i]] += 1
                    model.moves += rate * pair
    model.weights = {f: weights[i] for f, i in place.items()}
    return model


def _targets(text: str) -> list[tuple[int, int]]:
    """(start, end) of the secrets themselves in the patterns' matches: of assignments the value."""
    values = {m.start(): m.start(2) for m in _ASSIGN.finditer(text)}
    return [(values[s] if kind == "assign" else s, e) for s, e, kind in base_spans(text)]


def _tagged(run: list[tuple[int, int]], spans: list[tuple[int, int]]) -> list[int]:
    inside = [any(s < b and a < e for s, e in spans) for a, b in run]
    return [(_O if not here else _I if i and inside[i - 1] else _B) for i, here in enumerate(inside)]


def _variants(text: str, span: tuple[int, int], key: int, of_file: list[str]):
    """A match's surroundings with other values, so that the field does not learn the patterns' alphabets only."""
    rng = np.random.default_rng(zlib.crc32(f"{key}:{span[0]}".encode()))
    before, after = text[max(0, span[0] - 60):span[0]], text[span[1]:span[1] + 40]
    gap = _GAP.search(before)
    for signs in (_VALUES if gap else _VALUES[:1]):
        value = "".join(rng.choice(list(signs), 10 + int(rng.integers(20))))
        head, tail = before, after
        if gap:
            sign = str(rng.choice(["=", ":", ": ", " = ", '="', ': "']))
            head, tail = before[:gap.start()] + sign, sign[-1:].strip("=: ") + after.lstrip("\"'")
        near, at = head + value + tail, (len(head), len(head) + len(value))
        for run in segments(near):
            run = [t for t in run if t[1] > at[0] - 20][:LONGEST]
            if run and run[0][0] < at[1] and at[0] < run[-1][1]:
                yield _features(near, run, of_file), _tagged(run, [at])


def _examples(text: str, key: int) -> list[tuple[list[list[str]], list[int]]]:
    """The segments of a document that train the field, long ones in pieces."""
    spans, of_file = _targets(text), _file_features(text)
    sorts: tuple[list, list, list] = ([], [], [])  # with a match, codes, plain words
    for whole in segments(text):
        for at in range(0, len(whole), LONGEST):
            run = whole[at:at + LONGEST]
            a, b = run[0][0], run[-1][1]
            near = [s for s in spans if s[0] < b and a < s[1]]
            sort = 0 if near else 1 if b - a >= 8 and _CODE.search(text, a, b) else 2
            sorts[sort].append((zlib.crc32(f"{key}:{a}".encode()), run, near))
    chosen = [x for sort, most in zip(sorts, (PER_DOC, OTHERS, OTHERS)) for x in sorted(sort)[:most]]
    return ([(_features(text, run, of_file), _tagged(run, near)) for _, run, near in chosen]
            + [v for _, _, near in chosen for span in near[:1] for v in _variants(text, span, key, of_file)])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Field | None:
    """Fit a field on at most ``sample`` documents; None if no pattern occurs in the whole table."""
    text = F.col(text_col).cast("string")
    rows = docs.where(text.isNotNull()).select(F.xxhash64(F.col(id_col).cast("long"), text).alias("key"), text.alias("text"))

    def matches(batches):
        for batch in batches:
            held = [bool(base_spans(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(held, pa.bool_())], names=["key", "held"])

    marked = stored(rows.mapInArrow(matches, "key long, held boolean").distinct(), "secret_matches")
    with_match = marked.where("held").orderBy("key").limit(max(1, sample // 2))
    n = with_match.count()
    if not n:
        return None
    chosen = with_match.unionByName(marked.where("not held").orderBy("key").limit(n)).select("key")

    def examples(batches):
        for batch in batches:
            out: list[list] = [[], [], []]
            for key, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for features, tags in _examples(t, key):
                    for c, v in zip(out, (key, features, tags)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.list_(pa.list_(pa.string())), pa.list_(pa.int32())))],
                names=["key", "features", "tags"])

    # a row per chosen document, whatever the number of its copies, and at most PER_DOC + 2 OTHERS segments of it
    once = rows.join(F.broadcast(chosen), "key").groupBy("key").agg(F.min("text").alias("text"))
    found = once.mapInArrow(examples, "key long, features array<array<string>>, tags array<int>").collect()
    found = sorted(found, key=lambda r: (r["key"], str(r["features"])))
    return fit([([list(f) for f in r["features"]], list(r["tags"])) for r in found])


def field_spans(text: str, model: Field) -> list[tuple[int, int]]:
    """Spans that the field tags as secrets."""
    return spans_of_texts([text], model)[0]


def spans_of_texts(texts: list[str], model: Field) -> list[list[tuple[int, int]]]:
    """The field's spans of each text, in blocks of about BLOCK characters."""
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    gains, a = model.gains(), 0
    while a < len(texts):
        b, size = a + 1, len(texts[a])
        while b < len(texts) and size + len(texts[b]) <= BLOCK:
            size += len(texts[b])
            b += 1
        files = [gains.total(_file_features(t)) for t in texts[a:b]]
        for d, run in gains.open_runs(texts[a:b], files):
            start, out = None, found[a + d]
            for (first, last), tag in zip(run, gains.tags(gains.potentials(texts[a + d], run, files[d]))):
                if tag == _B or (tag == _O and start is not None):
                    if start is not None:
                        out.append((start, end))
                    start = first if tag == _B else None
                end = last
            if start is not None:
                out.append((start, end))
        a = b
    return found


def all_spans(text: str, model: Field | None) -> list[tuple[int, int, str]]:
    """The patterns' spans and the field's further ones, by start, then kind."""
    return all_spans_of([text], model)[0]


def all_spans_of(texts: list[str], model: Field | None) -> list[list[tuple[int, int, str]]]:
    out = [base_spans(t) for t in texts]
    for base, more in zip(out, spans_of_texts(texts, model) if model else []):
        extra = [(a, b, "crf") for a, b in more if not any(s < b and a < e for s, e, _ in base)]
        if extra:
            base += extra
            base.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return out


def scan(docs: DataFrame, model: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) per row; spans are structs of kind, start and end in code points, end exclusive."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        for batch in batches:
            spans = [[{"kind": k, "start": a, "end": b} for a, b, k in found]
                     for found in all_spans_of([t or "" for t in batch.column(1).to_pylist()], model)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span))], names=[id_col, "spans"])

    return docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string")).mapInArrow(
        run, f"`{id_col}` long, spans array<struct<kind: string, start: long, `end`: long>>")


def mask(text: str, spans: list[tuple[int, int, str]], label: str) -> str:
    out, at = [], 0
    for a, b, _ in spans:
        if a >= at:
            out += [text[at:a], label]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Field | None, text_col: str = "text", label: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``label``; null texts stay null."""
    names = docs.columns
    place = names.index(text_col)

    def run(batches):
        for batch in batches:
            texts = batch.column(place).to_pylist()
            spans = all_spans_of([t or "" for t in texts], model)
            texts = [t if t is None else mask(t, found, label) for t, found in zip(texts, spans)]
            columns = list(batch.columns)
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema.fields]))
