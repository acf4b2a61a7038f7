"""Plan-shape checks: the scale properties the design relies on."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kinstar.operators import fact as fact_ops
from kinstar.plans import pipeline
from kinstar.sources import fixture, store

SF_DIR = "/root/testdata/sf0.001"


def _formatted(df) -> str:
    jvm = df.sparkSession.sparkContext._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plan_wh"))
    person, family, relation = fixture.snapshot(spark, SF_DIR, 1)
    pipeline.run_increment(spark, root, person, family, relation, run_id="r1",
                           started_at=dt.datetime(2026, 1, 1), buckets=4)
    return root


def test_snapshot_slice_prunes_partitions(spark, warehouse):
    raw = store.read_raw(spark, warehouse, "raw_person_snapshot")
    plan = _formatted(store.snapshot_slice(raw, "r1").select("person_id"))
    assert "PartitionFilters: [isnotnull(run_id" in plan and "(run_id" in plan
    assert "ReadSchema: struct<person_id:string>" in plan


def test_merges_do_not_reshuffle_stored_versions(spark, warehouse):
    wh = pipeline.Warehouse(spark, warehouse)
    person, _, _ = fixture.snapshot(spark, SF_DIR, 2)
    spark.conf.set(pipeline.CO_PARTITION_CONF, "false")
    try:
        cur = wh.stored("dim_person_current")
        scd2_join = cur.join(person.select("person_id", "works"), "person_id", "full_outer")
        plan = _formatted(scd2_join)
        assert "Bucketed: true" in plan
        assert plan.count("Exchange (") == 1  # only the snapshot side moves

        fct = wh.stored("fact_person_relationship")
        edges = fct.select(*[F.col(c).alias(f"_e_{c}") for c in
                             ["source_person_id", "target_person_id", "source_relationship_role_code",
                              "start_date", "end_date", "end_reason"]]).withColumn(
            "_e_edge_key", F.xxhash64("_e_source_person_id", "_e_target_person_id",
                                      "_e_source_relationship_role_code", "_e_start_date",
                                      "_e_end_date", "_e_end_reason"))
        merge = fct.join(edges, (F.col(fact_ops.EDGE_HASH) == F.col("_e_edge_key"))
                         & (F.col("source_person_id") == F.col("_e_source_person_id")), "full_outer")
        plan = _formatted(merge)
        assert "Bucketed: true" in plan
        assert plan.count("Exchange (") == 1  # only the edges side moves
    finally:
        spark.conf.unset(pipeline.CO_PARTITION_CONF)

