"""Byte-pair token ids of texts, as packed little-endian 32-bit integers.

The ids are those of the ``tokenizers`` library for the given file. Byte-level
BPE treats each pre-token (a word with its leading space, a number, a run of
punctuation or of white space) by itself, so ids of pre-tokens are looked up in
a bounded table, and only unknown ones are merged (by ``tiktoken``, over the
file's own vocabulary, if its merges are in the order of its ids). That shortcut
is taken for texts of ordinary white space, ASCII and Latin letters alone, where
the pre-tokens can be told by a plain pattern; any other text, and texts that
hold a special token's string, go through ``tokenizers`` as a whole. Both ways
give the same ids (tests/llm/test_tokens.py compares them).
"""

from __future__ import annotations

import functools
import json
import re
from array import array
from collections.abc import Callable

import numpy as np

#: Entries of the table of pre-tokens in each Python worker (about 40 MB).
TABLE = 250_000

_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼½¾"
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-ɏ]*")
# fixed values: the pre-token pattern of byte-level BPE, for the characters of _PLAIN
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+")


def _byte_of() -> dict[str, int]:
    """Byte-level BPE's printable stand-in of every byte: printable Latin-1
    characters stand for themselves, the other bytes for U+0100 onwards."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranks(model: dict) -> dict[bytes, int] | None:
    """The vocabulary as ranks by bytes, if its merges stand in the order of their ids."""
    merged = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
    ids = [model["vocab"][m.replace(" ", "", 1)] for m in merged]
    if ids != sorted(set(ids)) or model.get("dropout") or model.get("ignore_merges") or model.get("unk_token"):
        return None
    byte_of = _byte_of()
    made = set(ids)
    return {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items()
            if i in made or len(token) == 1 and token in byte_of}


class _Table(dict):
    """Packed ids by pre-token; beyond its size, unknown ones are merged each time."""

    def __init__(self, merge: Callable[[bytes], list[int]]):
        super().__init__()
        self.merge = merge

    def __missing__(self, piece: str) -> bytes:
        packed = array("I", self.merge(piece.encode())).tobytes()
        if len(self) < TABLE and len(piece) <= 64:
            self[piece] = packed
        return packed


@functools.lru_cache(maxsize=2)
def bpe_encoder(path: str, ordinary: bool = False) -> Callable[[str], bytes]:
    """Function from a text to its packed ids, for a byte-level BPE file of ``tokenizers``;
    with ``ordinary`` the special tokens' strings in a text are ordinary text."""
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = ordinary
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = [t["content"] for t in spec["added_tokens"]]
    split = spec.get("pre_tokenizer") or {}
    ranks = None
    if (spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
            and not split.get("add_prefix_space") and spec.get("truncation") is None):
        ranks = _ranks(spec["model"])
    if ranks is not None:
        merger = tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
        table = _Table(merger._core_bpe.encode_single_piece)

    def encode(text: str) -> bytes:
        if ranks is None or not _PLAIN.fullmatch(text) or any(s in text for s in special):
            return np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return b"".join(map(table.__getitem__, _PIECES.findall(text)))

    return encode
