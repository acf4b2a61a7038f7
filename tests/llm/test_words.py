"""Word and shingle hashes against regular expressions."""

from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kinstar.llm import words as W
from tests.llm.cases import lower


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="aB \t\n\r\x0b\x0c\x1c çé.😀Z", max_size=40), max_size=8))
def test_words_match_the_regular_expression(texts):
    seen = {}
    for row, end, words in W.blocks(pa.array(texts, pa.string())):
        for d in range(end - row):
            a, b = words.first[d], words.first[d + 1]
            got = [bytes(words.data[s:e]).decode() for s, e in zip(words.starts[a:b], words.ends[a:b])]
            assert got == re.findall(r"[^\x20\x09-\x0D]+", texts[row + d] or "")
            for word, h in zip(got, words.hashes[a:b].tolist()):
                assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 20])
def test_hashes_do_not_depend_on_the_blocks(monkeypatch, block):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["ab", "Abc", "ä", "longer-word", ""]) for _ in range(rng.randrange(30))) for _ in range(50)]
    monkeypatch.setattr(W, "BLOCK_BYTES", block)
    hashes = {}
    for row, end, words in W.blocks(pa.array(texts), lower=True):
        for d in range(end - row):
            a, b = words.first[d], words.first[d + 1]
            hashes[row + d] = words.hashes[a:b].tolist()
    known = {}
    for i, text in enumerate(texts):
        assert len(hashes[i]) == len(text.split())
        for word, h in zip(lower(text).split(), hashes[i]):
            assert known.setdefault(word, h) == h


def test_sliced_columns_and_windows():
    column = pa.array(["a b c", None, "b c d e", "c d"]).slice(1)
    (_, _, words), = W.blocks(column)
    assert [int(words.first[i + 1] - words.first[i]) for i in range(3)] == [0, 4, 2]
    w = W.window_hashes(words.hashes, 2)  # bc cd de | ec | cd
    assert w[1] == w[4] and len({int(x) for x in w}) == 4
    assert len(W.shingle_set(words.hashes[4:6], 3)) == 1 and len(W.shingle_set(words.hashes[:0], 3)) == 0


def test_a_worker_keeps_little_however_long_the_texts(monkeypatch):
    monkeypatch.setattr(W, "_powers", {base: p[:1] for base, p in W._powers.items()})
    column = pa.array(["word " * 600] * 1500 + ["long " * 500_000])
    assert sum(end - row for row, end, _ in W.blocks(column)) == 1501
    assert sum(p.nbytes for p in W._powers.values()) < 10_000_000


def test_hashes_do_not_depend_on_the_parts_they_are_taken_in(monkeypatch):
    column = pa.array(["some words " * 900, "é ü" * 50, None, "x" * 5000])
    whole = [w.hashes.tolist() for _, _, w in W.blocks(column, lower=True)]
    monkeypatch.setattr(W, "_PART_BYTES", 64)
    assert [w.hashes.tolist() for _, _, w in W.blocks(column, lower=True)] == whole
    monkeypatch.setattr(W, "_powers", {base: p[:1] for base, p in W._powers.items()})
    W.split_words(*W.column_bytes(pa.array(["word " * 40_000])))
    assert max(map(len, W._powers.values())) < 1000  # a part at a time, whatever the block
