"""The stored warehouse: run ids, retries, buckets, clean-up."""

from __future__ import annotations

import datetime as dt
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from kinstar.plans import oracle_sql as O
from kinstar.plans import pipeline, registry
from kinstar.session import ensure_checkpoint_dir
from kinstar.sources import fixture, store
from tests import demo_graph as G
from tests.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"


def increment(spark, root, seq, run_id, **kw):
    return pipeline.run_increment(spark, root, *fixture.snapshot(spark, SF_DIR, 1 if seq == 3 else seq), run_id=run_id,
                                  started_at=dt.datetime(2026, 1, seq, 2), **kw)


def contents(spark, root):
    wh = pipeline.Warehouse(spark, root)
    dim = wh.table("dim_person").drop("created_at")
    fact = wh.table("fact_person_relationship").drop("created_at", "updated_at")
    return sorted(map(str, dim.collect())), sorted(map(str, fact.collect()))


def renamed(rows, ids):
    for new, old in ids.items():
        rows = [r.replace(f"'{new}'", f"'{old}'") for r in rows]
    return sorted(rows)


@pytest.fixture(scope="module")
def plain(spark, tmp_path_factory):
    """Three runs with plain ids."""
    root = str(tmp_path_factory.mktemp("plain"))
    for s in (1, 2, 3):
        increment(spark, root, s, f"r{s}")
    return contents(spark, root)


def test_contents_equal_the_oracle(spark, plain):
    con = duck(SF_DIR)
    for name in ("stored_dim_person", "stored_fact"):
        res = compare(registry.QUERIES[name](spark, SF_DIR), con, registry.ORACLE[name])
        assert res["ok"], res
    assert plain[0] and plain[1] and O.FACT_OUT


@pytest.mark.parametrize("ids", [["2026-01-01", "2026-01-02", "2026-01-03"], ["001", "002", "003"],
                                 ["a/b 1", "it's=2", "%3"]], ids=["dates", "numbers", "signs"])
def test_run_ids_stay_text(spark, tmp_path, plain, ids):
    root = str(tmp_path / "it's a warehouse")
    for s, run in enumerate(ids, 1):
        # every run and the last reads in a session of their own
        increment(spark.newSession(), root, s, run)
    fresh = spark.newSession()
    wh = pipeline.Warehouse(fresh, root)
    for table, column in (("dim_person", "valid_from_run_id"), ("dim_person", "valid_to_run_id"),
                          ("fact_person_relationship", "first_seen_run_id")):
        assert dict(wh.table(table).dtypes)[column] == "string"
    assert dict(store.read_raw(fresh, root, "raw_person_snapshot").dtypes)["run_id"] == "string"
    assert {r.run_id for r in store.read_raw(fresh, root, store.RUN_LOG_TABLE).collect()} == set(ids)
    got = [[r.replace('"', "'") for r in rows] for rows in contents(fresh, root)]
    assert tuple(renamed(rows, dict(zip(ids, ("r1", "r2", "r3")))) for rows in got) == plain


def test_default_run_id(spark, tmp_path):
    result = pipeline.run_increment(spark, str(tmp_path), *G.initial(spark))
    assert str(uuid.UUID(result.run_id)) == result.run_id == result.current_run
    dim = pipeline.Warehouse(spark, str(tmp_path)).table("dim_person")
    assert {r[0] for r in dim.select("valid_from_run_id").distinct().collect()} == {result.run_id}


class Crash(RuntimeError):
    pass


@pytest.mark.parametrize("written", [1, 2, 3])
def test_a_half_finished_extraction_can_be_retried(spark, tmp_path, monkeypatch, plain, written):
    root = str(tmp_path)
    increment(spark, root, 1, "r1")
    real, calls = store.write_snapshot, []

    def crashing(*args):
        real(*args)
        calls.append(args)
        if len(calls) == written:
            raise Crash

    monkeypatch.setattr(store, "write_snapshot", crashing)
    with pytest.raises(Crash):
        increment(spark, root, 2, "r2")
    monkeypatch.setattr(store, "write_snapshot", real)
    for s in (2, 3):
        increment(spark, root, s, f"r{s}")
    assert contents(spark, root) == plain


def test_a_run_that_fails_before_its_commit_can_be_retried(spark, tmp_path, monkeypatch, plain):
    root = str(tmp_path)
    increment(spark, root, 1, "r1")
    before = contents(spark, root)
    real = pipeline.Warehouse.commit

    def crash(*args):
        raise Crash

    monkeypatch.setattr(pipeline.Warehouse, "commit", crash)
    with pytest.raises(Crash):
        increment(spark, root, 2, "r2")
    monkeypatch.setattr(pipeline.Warehouse, "commit", real)
    assert contents(spark, root) == before  # the closed versions of r2 lie there, unseen
    for s in (2, 3):
        increment(spark, root, s, f"r{s}")
    assert contents(spark, root) == plain
    left = pipeline.Warehouse(spark, root).vacuum(keep=1)
    assert len(left) == 6  # two superseded and one uncommitted version of both rewritten tables
    assert contents(spark, root) == plain


def test_a_committed_run_is_not_merged_again(spark, tmp_path):
    root = str(tmp_path)
    for s in (1, 2):
        increment(spark, root, s, f"r{s}")
    before = contents(spark, root)
    assert increment(spark, root, 2, "r2").written == {}
    assert contents(spark, root) == before


def files(version):
    return [p for p in Path(version.path).iterdir() if p.name.startswith("part-")]


def test_bucket_counts_double_and_files_do_not_multiply(spark, tmp_path):
    root = str(tmp_path)
    increment(spark, root, 1, "r1", buckets=8)
    same = increment(spark, root, 2, "r2", buckets=8).written
    double = increment(spark, root, 3, "r3", buckets=16).written
    for table in ("dim_person_current", "fact_person_relationship"):
        assert len(files(same[table])) <= 2 * 8  # a file for kept rows and one for inserted ones
        assert len(files(double[table])) <= 2 * 16


def test_bucket_count():
    unit = pipeline.BYTES_PER_BUCKET
    assert [pipeline.bucket_count(n * unit) for n in (0, 1, 2, 3, 5, 5000)] == [1, 1, 2, 4, 8, 8192]
    assert [pipeline.bucket_count(n * unit, 8) for n in (1, 8, 9, 16, 17)] == [8, 8, 16, 16, 32]


def test_a_run_leaves_no_intermediate_tables(spark, tmp_path):
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = {p for p in folder.iterdir() if "-" in p.name}
    increment(spark, str(tmp_path), 1, "r1")
    assert {p for p in folder.iterdir() if "-" in p.name} <= before


def test_reports_read_current_versions_only(spark, tmp_path):
    root = str(tmp_path)
    for s in (1, 2):
        increment(spark, root, s, f"r{s}")
    wh = pipeline.Warehouse(spark, root)
    current = wh.stored("dim_person_current")
    assert current.where(~F.col("is_current")).isEmpty()
    assert not any(pipeline.HISTORY in f for f in current.inputFiles())


def test_a_bucket_holds_what_one_task_can_sort():
    # a fact of 5 million edges takes about 25 MB: one task sorted it whole, in 2 GB
    assert pipeline.bucket_count(25 << 20) >= 4


def test_a_runs_tasks_grow_with_its_edges(spark, tmp_path, monkeypatch):
    """Not by the number of cores: a task takes a bounded part of the shuffled bytes."""
    seen = []

    def merge(*args):
        seen.append([spark.conf.get(name) for name in pipeline.RUN_CONF])
        rows = spark.range(2_000_000, numPartitions=4).selectExpr("uuid() AS id").repartition("id")
        seen.append(rows.sortWithinPartitions("id").rdd.getNumPartitions())

    monkeypatch.setattr(pipeline, "_merge_run", merge)
    monkeypatch.setattr(pipeline, "extract", lambda *args: True)
    before = [spark.conf.get(name, None) for name in pipeline.RUN_CONF]
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    try:
        pipeline.run_increment(spark, str(tmp_path), None, None, None, run_id="r1")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert seen[0] == ["false", "false", "1m"] and seen[1] > 2 * spark.sparkContext.defaultParallelism
    assert [spark.conf.get(name, None) for name in pipeline.RUN_CONF] == before
