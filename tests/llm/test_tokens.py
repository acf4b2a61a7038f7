"""Packed ids against the tokenizers library, and the packing's exact round trip."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kinstar.llm import packing, token_counts
from kinstar.llm.queries import QUERIES
from kinstar.llm.tokens import bpe_encoder
from tests.llm.cases import documents, nothing, rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)
SF = "/root/testdata/sf0.001"


def ids(text: str) -> list[int]:
    return WHOLE.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'streZ019²½ªµßçÿĀɏ \t\n\r.,-<|>_ \x85 ٣中é😀\x1c"), max_size=60)
       | st.sampled_from(["<|endoftext|>", "a<|endoftext|> b", "it's 'll  'T x", "   a  \n\n b ", "\t\tx", " 's"]))
def test_ids_equal_the_library(text):
    assert np.frombuffer(bpe_encoder(PATH)(text), "<u4").tolist() == ids(text)


def test_ids_of_real_texts(spark):
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect():
        assert np.frombuffer(bpe_encoder(PATH)(r.text), "<u4").tolist() == ids(r.text)


def check_pieces(found, texts, capacity):
    by_doc, by_sequence = {}, {}
    for r in found:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    want = {}
    for key, text in texts:
        want.setdefault(key, []).append([*ids(text), 0])
    assert {k: len(v) for k, v in want.items()} == {k: sum(p["start"] == 0 for p in v) for k, v in by_doc.items()}
    for key, copies in want.items():
        if len(copies) == 1:  # every id in exactly one piece
            own, at = copies[0], 0
            for p in sorted(by_doc[key], key=lambda p: p["start"]):
                part = np.array(own[at:at + p["length"]], dtype="<u4").tobytes()
                assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(own), zlib.crc32(part))
                at += p["length"]
            assert at == len(own)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= capacity
    total = sum(r["length"] for r in found)
    return 1 - total / (capacity * len(by_sequence)) if by_sequence else 0.0


def test_packing_query_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    waste = check_pieces([r.asDict() for r in QUERIES["op7_karmarkar_karp_packing"](spark, SF).collect()],
                         [(r.doc_id, r.text) for r in docs], 1024)
    assert waste < 0.03


def test_pipeline_keeps_the_packed_ids(spark):
    import corpus_pipeline
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
    found = dict(corpus_pipeline.STAGES)["packing"](spark, docs, "").collect()
    check_pieces([r.asDict() for r in found], [(r.doc_id, r.text) for r in docs.collect()], 1024)
    assert all(zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in found)


def test_digests_come_from_the_packed_ids(spark):
    df = spark.createDataFrame([(1, 0, 99, 99, 5, 0, 0, [1, 2]), (2, 0, 99, 99, 5, 0, 2, [3]), (3, 0, 99, 99, 5, 0, 3, [])],
                               "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>")
    got = packing.digests(df.coalesce(1)).orderBy("doc_id").collect()
    assert [(r.length, r.ids_crc32) for r in got] == [(len(i), zlib.crc32(np.array(i, dtype="<u4").tobytes())) for i in ([1, 2], [3], [])]


def test_packing_edge_cases(spark):
    found = packing.pack(documents(spark), PATH, capacity=64).collect()
    check_pieces([r.asDict() for r in found], [(r[0], r[1]) for r in rows()], 64)
    assert all(len(r.ids) == r.length for r in found)
    assert packing.pack(nothing(spark), PATH).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=60))
def test_windows_partition_the_pieces(sizes):
    windows = packing.pack_group(sizes, 50)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in w) <= 50 for w in windows)


def test_differencing_of_a_known_case():
    # Karmarkar and Karp's example: differencing ends with a difference of 2
    sums = sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in packing.difference([8, 7, 6, 5, 4], 2))
    assert sums == [14, 16]


@pytest.mark.parametrize("block", [3, 16, 1 << 20])
def test_separator_scan_against_direct_counts(spark, monkeypatch, tmp_path, block):
    monkeypatch.setattr(token_counts, "BLOCK", block if block > 3 else 512)
    folder = f"file://{tmp_path}"
    placed = token_counts.write_token_files(documents(spark), folder, PATH, 50256, 2)
    got = placed.join(token_counts.scan_token_files(spark, folder, placed, 50256, 2), ["file", "ordinal"])
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    want = sorted((r[0] is None, r[0] or 0, len(plain.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows())
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens) for r in got.collect()) == want


def test_token_count_query_against_the_tokenizer(spark):
    from kinstar.llm.queries import QUERIES
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = QUERIES["op9_separator_scan"](spark, "/root/testdata/sf0.001").collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == sorted(
        (r.doc_id, len(plain.encode(r.text or "", add_special_tokens=False).ids)) for r in docs)


def test_scan_counts_a_last_document_without_separator(spark, tmp_path):
    np.array([9, 5, 5, 9, 9, 5], dtype="<u2").tofile(tmp_path / "a.bin")
    np.array([5] * 2500 + [9], dtype="<u2").tofile(tmp_path / "b.bin")
    files = spark.createDataFrame([("a.bin",), ("b.bin",)], "file string")
    old, token_counts.BLOCK = token_counts.BLOCK, 1000
    try:
        got = token_counts.scan_token_files(spark, f"file://{tmp_path}", files, 9, 2).collect()
    finally:
        token_counts.BLOCK = old
    assert sorted(tuple(r) for r in got) == [("a.bin", 0, 0, 0), ("a.bin", 1, 1, 2), ("a.bin", 2, 4, 0), ("a.bin", 3, 5, 1),
                                             ("b.bin", 0, 0, 2500)]


def test_separator_scan_of_nothing(spark, tmp_path):
    placed = token_counts.write_token_files(nothing(spark), f"file://{tmp_path}", PATH, 50256, 2)
    assert token_counts.scan_token_files(spark, f"file://{tmp_path}", placed, 50256, 2).collect() == []
