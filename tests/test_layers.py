"""Merge-on-read tables, digests of key leaves, and the checks of a run's changes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kinstar.operators import diff, digest, layers
from kinstar.operators.checks import ConstraintViolation
from kinstar.plans import pipeline
from kinstar.sources import fixture, store
from tests.test_plans import _formatted

SF_DIR = "/root/testdata/sf0.001"


def run(spark, root, n, snapshot, **kw):
    return pipeline.run_increment(spark, root, *snapshot, run_id=f"r{n}", started_at=dt.datetime(2026, 1, n, 2), buckets=8,
                                  compact_share=float("inf"), **kw)


def test_differing_leaves(spark):
    a = spark.range(5000).select("id", (F.col("id") % 7).cast("string").alias("v"))
    b = a.where("id <> 17").withColumn("v", F.when(F.col("id") == 4321, None).otherwise(F.col("v"))).repartition(5)
    digests = [digest.leaf_digests(x, ["id"], ["v"], 512) for x in (a, b)]
    want = {r[0] for r in a.where("id in (17, 4321)").select(digest.leaf_of(["id"], 512)).collect()}
    assert digest.differing_leaves(*digests) == sorted(want)
    assert digest.differing_leaves(digests[0], digest.leaf_digests(a.repartition(3), ["id"], ["v"], 512)) == []
    empty = digest.leaf_digests(a.limit(0), ["id"], ["v"], 512)
    assert len(digest.differing_leaves(digests[0], empty)) == digests[0].count()


def test_diff_by_leaves_equals_the_join_and_shuffles_only_what_differs(spark):
    a = spark.range(4000).select("id", F.concat(F.lit("v"), F.col("id") % 9).alias("v"), (F.col("id") * 2).alias("w"))
    b = a.where("id not between 100 and 105").withColumn("v", F.when(F.col("id") == 110, "x").otherwise(F.col("v"))).unionByName(
        spark.createDataFrame([(9000, "n", 1), (None, "n", 2)], "id long, v string, w long"))
    got = diff.snapshot_diff_by_leaves(a, b, ["id"], ["v"], ["w"], leaf=F.floor(F.col("id") / 50))
    want = diff.snapshot_diff(a, b, ["id"], ["v"], ["w"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "FullOuter" in _formatted(got) and got.where("change_type <> 'same'").count() == 9


def test_a_run_reads_and_writes_what_changed(spark, tmp_path, monkeypatch):
    root, snapshot = str(tmp_path), fixture.snapshot(spark, SF_DIR, 1)
    run(spark, root, 1, snapshot)
    person, family, relation = snapshot
    one = person.where("works is not null").orderBy("person_id").first()["person_id"]
    moved = person.withColumn("works", F.when(F.col("person_id") == one, "elsewhere").otherwise(F.col("works")))
    read = []
    real = pipeline.Warehouse.read_buckets
    monkeypatch.setattr(pipeline.Warehouse, "read_buckets", lambda self, name, v, held: read.append(held) or real(self, name, v, held))
    written = run(spark, root, 2, (moved, family, relation)).written
    assert [len(held) for held in read] == [1]  # of 8 buckets
    wh = pipeline.Warehouse(spark, root)
    delta = spark.read.parquet(written["dim_person_current_delta"].path)
    assert [(r.person_id, r.works) for r in delta.collect()] == [(one, "elsewhere")]
    edges = spark.read.parquet(written["fact_person_relationship_delta"].path)
    touching = wh.table("fact_person_relationship").where((F.col("source_person_id") == one) | (F.col("target_person_id") == one))
    assert 0 < edges.count() == touching.count()
    base = wh.latest_versions()["fact_person_relationship"]
    assert store.stored_bytes(spark, base.deltas[0]) < store.stored_bytes(spark, base.path)
    # untouched rows read as seen by the newest run
    assert {r[0] for r in wh.table("fact_person_relationship").select("last_seen_run_id").distinct().collect()} == {"r2"}
    # nothing changes: nothing is read of the persons and no delta is written
    again = run(spark, root, 3, (moved, family, relation)).written
    assert read[1:] == [set()] and not [name for name in again if name.endswith("_delta")]
    assert pipeline.Warehouse(spark, root).table("fact_person_relationship").where("last_seen_run_id = 'r3'").count() == wh.table("fact_person_relationship").count()


def test_edges_that_come_and_go(spark, tmp_path):
    """Live in r1, r2, away in r3, back in r4 and r5: two spans, and each run's state as it was."""
    root, (person, family, relation) = str(tmp_path), fixture.snapshot(spark, SF_DIR, 1)
    some = relation.where("relationship_type = 'SPOUSE_OF'").orderBy("person_id").limit(6).select("person_id", "family_id")
    less = relation.join(some, ["person_id", "family_id"], "left_anti").select(*relation.columns)
    live = {}
    for n in range(1, 6):
        run(spark, root, n, (person, family, less if n == 3 else relation))
        fact = pipeline.Warehouse(spark, root).table("fact_person_relationship")
        live[f"r{n}"] = {r[0] for r in fact.where("not is_deleted").select("relationship_sk").collect()}
    assert len(live["r3"]) < len(live["r2"]) == len(live["r4"])
    spans = pipeline.Warehouse(spark, root).edge_intervals().collect()
    for name, want in live.items():
        assert {r.relationship_sk for r in spans if r.from_run_id <= name and (r.to_run_id is None or r.to_run_id > name)} == want
    back = live["r2"] - live["r3"]
    assert sorted((r.from_run_id, r.to_run_id) for r in spans if r.relationship_sk in back) == sorted([("r1", "r3"), ("r4", None)] * len(back), key=str)


def test_stored_fact_is_not_shuffled(spark, tmp_path):
    root, snapshot = str(tmp_path), fixture.snapshot(spark, SF_DIR, 1)
    run(spark, root, 1, snapshot)
    wh = pipeline.Warehouse(spark, root)
    v = wh.latest_versions()["fact_person_relationship"]
    base, other = wh.read_version("fact_person_relationship", v), spark.read.parquet(v.path)
    names = {"source_relationship_role_code": "relationship_role_code"}
    edges = other.select(*[F.col(c).alias(f"_e_{names.get(c, c)}") for c in [*layers.INTERVAL[1:-2], *layers.REFRESHED, layers.EDGE_HASH]],
                         F.lit(True).alias("_e_in"), F.lit(True).alias("_e__enriched"))
    state = layers.not_replaced(base, other.where("relationship_sk < 9"), "edge_key", "relationship_sk")
    merge = layers.fact_changes([state], edges, "r2", dt.datetime(2026, 1, 2), "r1", None)
    check = base.join(edges, layers.edge_condition(), "left_semi")
    kept = {k: spark.conf.get(k, None) for k in (pipeline.CO_PARTITION_CONF, "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set(pipeline.CO_PARTITION_CONF, "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df, moved in ((merge, 2), (check, 1)):  # the delta's and the run's rows move, the stored ones do not
            plan = _formatted(df)
            assert plan.count("Bucketed: true") == 1 and plan.count("Exchange (") == moved
    finally:
        for k, value in kept.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def test_a_violation_stops_the_commit(spark, tmp_path, monkeypatch):
    root, snapshot = str(tmp_path), fixture.snapshot(spark, SF_DIR, 1)
    real = layers.fact_inserts

    def doubled(*args):
        rows = real(*args)
        return rows.unionByName(rows.limit(1))

    monkeypatch.setattr(layers, "fact_inserts", doubled)
    with pytest.raises(ConstraintViolation):
        run(spark, root, 1, snapshot)
    assert pipeline.Warehouse(spark, root).table("fact_person_relationship") is None
    # keys that are stored already
    monkeypatch.setattr(layers, "fact_inserts", real)
    run(spark, root, 1, snapshot)
    monkeypatch.setattr(layers, "fact_inserts", lambda edges, known, *rest: real(edges, [], *rest))
    with pytest.raises(ConstraintViolation):
        run(spark, root, 2, snapshot)
    assert pipeline.Warehouse(spark, root).last_run()[0] == "r1"
