"""Exact top-k search and WARC archives, against brute force and by round trip."""

from __future__ import annotations

import gzip
import hashlib
import math
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kinstar.llm import files, topk, warc

VECTORS = "vec_id long, embedding array<float>, label int, impacts string, shard long"


def brute_topk(rows, k=5):
    fit = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
           if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in fit:
        if i % 50 == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        scored = sorted((-min(max(sum(a * b for a, b in zip(v, w)), -2 ** 63), 2 ** 63 - 1), i) for i, w in fit if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def got_topk(df):
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect())


def vectors(spark, rows):
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    return spark.createDataFrame([(i, v, None, None, None) for i, v in rows], VECTORS).repartition(3), rows


@pytest.mark.parametrize("shard", [7, 64, 4096])
def test_topk_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "SHARD", shard)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 8).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[50][1]) for i in range(40)]  # ties
    rows += [(100, rows[3][1]), (2000, [0.0] * 8), (2050, [1.0] * 3), (2051, [0.5] * 3), (2100, None), (2150, []),
             (2400, [2.0 ** 21] * 8), (2450, [-3e6, 1.0] + [0.0] * 6), (2451, [1e30] + [1.0] * 7), (2500, [3e37, -3e37] + [1.0] * 6),
             (2200, [math.nan] * 8), (2250, [math.inf] + [0.0] * 7), (2300, [None] + [0.0] * 7), (None, [0.1] * 8), (2350, [9.0])]
    df, rows = vectors(spark, rows)
    assert got_topk(df) == brute_topk(rows)


def test_topk_of_nothing(spark):
    assert got_topk(vectors(spark, [])[0]) == []
    assert got_topk(vectors(spark, [(50, [1.0])])[0]) == []


def test_a_shard_stops_early_only_with_proof(monkeypatch):
    rng = np.random.default_rng(5)
    impacts = rng.integers(-20, 20, (3000, 6))
    impacts[:8] += 200
    shard, rescored = topk.Shard(np.arange(3000), impacts), []
    real = np.lexsort
    monkeypatch.setattr(topk.np, "lexsort", lambda keys: rescored.append(len(keys[0])) or real(keys))
    query = np.array([50, 60, 10, 5, 40, 30])
    ids, scores = shard.search(-1, query, 5)
    every = impacts @ query
    assert sorted(scores, reverse=True) == sorted(every, reverse=True)[:5] and rescored[0] < 3000
    assert set(ids) <= set(np.flatnonzero(every >= sorted(every)[-5]))


def test_given_vectors_are_proven_not_rescored(monkeypatch):
    """Dense vectors are proven out by the bounds, too: few are left to rescore."""
    table = pq.read_table("/root/testdata/sf0.01/embeddings.parquet")
    matrix = np.floor(np.array(table.column("embedding").to_pylist(), dtype=np.float64) * 256).astype(np.int64)
    ids = table.column("vec_id").to_numpy()
    shard, rescored = topk.Shard(ids, matrix), []
    real = np.lexsort
    monkeypatch.setattr(topk.np, "lexsort", lambda keys: rescored.append(len(keys[0])) or real(keys))
    for q in np.flatnonzero(ids % 50 == 0).tolist():
        _, scores = shard.search(int(ids[q]), matrix[q], 5)
        assert scores.tolist() == sorted((matrix @ matrix[q])[ids != ids[q]].tolist(), reverse=True)[:5]
    assert max(rescored) <= 20


def test_only_the_members_postings_are_processed_once_they_are_few(monkeypatch):
    rng = np.random.default_rng(8)
    impacts = rng.integers(-150, 150, (2000, 64))
    shard, summed = topk.Shard(np.arange(2000), impacts), []
    real = np.bincount
    monkeypatch.setattr(topk.np, "bincount", lambda of, *a, **kw: summed.append(len(of)) or real(of, *a, **kw))
    for query in rng.integers(-150, 150, (20, 64)):
        summed.clear()
        _, scores = shard.search(-1, query, 5)
        assert scores.tolist() == sorted((impacts @ query).tolist(), reverse=True)[:5]
        assert sum(summed) < 0.9 * impacts.size and max(summed) <= topk.SUMMED + 2000


PAGES = "page_id long, url string, html string, digest string, payload string, id string, last long"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", None, "y", 3) for r in rows], PAGES).repartition(3)


def page_rows():
    rng = random.Random(2)
    big, other = "é" * 700, "<p>" + "b" * 2000
    rows = [(i, f"http://h/{i}", rng.choice([big, other, "small", None, "", big + str(i)])) for i in range(60)]
    return rows + [(10 ** 12, "http://far/ away\r\n", big), (10 ** 12 + 1, None, "x" * 300_000), (None, "http://n/", big),
                   (None, None, None), (59, "http://h/again", other), (59, "http://h/again", other), (-7, "u", other)]


def brute_warc(rows):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if j is not None and (h or "").encode() == data]
        last = max(same, default=None)
        revisit = len(data) >= 1000 and last is not None and i != last
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=str)


def test_warc_round_trip(spark, tmp_path):
    rows = page_rows()
    records = warc.page_records(pages(spark, rows), "page_id", "url", "html")
    manifest = warc.write_archive(records, f"file://{tmp_path}/a", shard_bytes=20_000, roll_bytes=800)
    back = warc.read_archive(spark, f"file://{tmp_path}/a").collect()
    assert sorted(((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=str) == brute_warc(rows)
    texts = sorted((r.id, bytes(r.payload)) for r in back if r.record_type == "response" and r.id is not None)
    assert texts == sorted((i, (h or "").encode()) for (i, _, h) in rows
                           if (i, (h or "")) in {(r.id, bytes(r.payload).decode()) for r in back if r.payload is not None} and i is not None)
    listed = manifest.collect()
    assert sum(m.records for m in listed) == len(rows) and len({m.shard for m in listed}) > 2 and any(m.part for m in listed)
    for m in listed:
        data = (tmp_path / "a" / m.file).read_bytes()
        assert len(data) == m.bytes and hashlib.sha256(data).hexdigest() == m.sha256
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == m.records
    names = {p.name for p in (tmp_path / "a").iterdir()}
    assert names == {m.file for m in listed} | {"manifest.parquet"}


def test_warc_files_are_the_same_for_any_partitioning(spark, tmp_path):
    files = []
    for n in (1, 5):
        records = warc.page_records(pages(spark, page_rows()).repartition(n), "page_id", "url", "html")
        files.append(sorted(map(tuple, warc.write_archive(records, f"file://{tmp_path}/{n}", 1000, 20_000, 800).collect())))
    assert files[0] == files[1]


def test_warc_bounds_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(warc, "BINS", 8)
    rows = [(i if i < 500 else 10 ** 9 + i, None, "x" * 100) for i in range(1000)]
    records = warc.page_records(pages(spark, rows), "page_id", "url", "html")
    bounds = warc.shard_bounds(records, 10_000)
    ids = np.array([r[0] for r in rows])
    counts = np.bincount(np.searchsorted(bounds, ids, side="right"))
    assert counts.sum() == 1000 and counts.max() <= 100 and len(counts) <= 24


def test_the_query_rolls_files(spark, tmp_path, monkeypatch):
    """With the registered query's parameters a shard has several parts."""
    records = warc.page_records(spark.read.parquet("/root/testdata/sf0.1/pages.parquet"), "page_id", "url", "html")
    listed = warc.write_archive(records, f"file://{tmp_path}/q", min_bytes=1000).collect()
    assert max(m.part for m in listed) >= 2 and all(m.bytes >= warc.ROLL_BYTES for m in listed
                                                    if any(n.shard == m.shard and n.part > m.part for n in listed))


def test_many_shards_keep_their_size(spark):
    """The number of shards follows the bytes, beyond some thousands too."""
    records = warc.page_records(pages(spark, [(i, None, "x" * 100) for i in range(6000)]), "page_id", "url", "html")
    assert len(warc.shard_bounds(records, 100)) == 5999


def test_null_ids_are_spread(spark, tmp_path):
    rows = [(i, None, "y" * 500 + str(i)) for i in range(40)] + [(None, None, f"{i}" * 300) for i in range(100, 160)]
    records = warc.page_records(pages(spark, rows), "page_id", "url", "html")
    listed = warc.write_archive(records, f"file://{tmp_path}/n", 1000, 2_000).collect()
    assert len(listed) > 5 and max(m.records for m in listed) < 40
    back = warc.read_archive(spark, f"file://{tmp_path}/n").collect()
    assert sorted(((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=str) == brute_warc(rows)


def test_object_store_names():
    assert files.known_uri("s3a://bucket/a") == "s3://bucket/a" and files.known_uri("hdfs://n/a") == "hdfs://n/a"
    assert files.known_uri("/tmp/a") == "/tmp/a" and files.known_uri("file:///tmp/a") == "file:///tmp/a"


def test_warc_of_nothing_ignores_stray_files(spark, tmp_path):
    records = warc.page_records(pages(spark, []), "page_id", "url", "html")
    assert warc.write_archive(records, f"file://{tmp_path}/e").collect() == []
    (tmp_path / "e" / "_temporary-left").write_bytes(b"half a file")
    assert warc.read_archive(spark, f"file://{tmp_path}/e").collect() == []
