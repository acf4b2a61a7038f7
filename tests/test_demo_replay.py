"""Golden replay of the demo graph through the three scenarios (FIXTURES.md §2)."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kinstar.plans import pipeline, reports
from tests import demo_graph as G

AS_OF = dt.date(2026, 6, 30)

# (dim rows, current, expired), (fact rows, live, deleted), (inserted, soft-deleted),
# live edges PARENT/CHILD/SIBLING/HALF_SIBLING/HUSBAND/WIFE, R1 rows,
# R2 outcomes Active/Both/Husband/Wife/Divorced, R3 rows by depth 1..5
EXPECTED = {
    "initial": ((36, 36, 0), (150, 150, 0), (150, 0), (46, 46, 30, 4, 12, 12), 150,
                (5, 4, 2, 0, 1), (46, 50, 52, 40, 8)),
    "s01": ((39, 39, 0), (172, 172, 0), (22, 0), (50, 50, 40, 6, 13, 13), 172,
            (6, 4, 2, 0, 1), (50, 54, 56, 48, 8)),
    "s02": ((42, 39, 3), (174, 172, 2), (2, 2), (50, 50, 40, 6, 13, 13), 172,
            (5, 5, 1, 0, 2), (50, 54, 56, 48, 8)),
    "s03_wrong": ((43, 40, 3), (180, 178, 2), (6, 0), (52, 52, 42, 6, 13, 13), 178,
                  (5, 5, 1, 0, 2), (52, 56, 60, 48, 8)),
    "s03_fixed": ((43, 40, 3), (192, 184, 8), (12, 6), (52, 52, 48, 6, 13, 13), 184,
                  (5, 5, 1, 0, 2), (52, 56, 58, 52, 8)),
}
ROLES = ["PARENT", "CHILD", "SIBLING", "HALF_SIBLING", "SPOUSE_HUSBAND", "SPOUSE_WIFE"]
OUTCOMES = ["Active", "Both deceased", "Husband deceased", "Wife deceased", "Divorced"]


def _observe(spark, root, run):
    wh = pipeline.Warehouse(spark, root)
    dim, fct = wh.table("dim_person"), wh.table("fact_person_relationship")
    role, date = wh.table("dim_relationship_role"), wh.table("dim_date")
    d = dim.agg(F.count(F.lit(1)), F.count_if("is_current"), F.count_if(~F.col("is_current"))).first()
    f = fct.agg(F.count(F.lit(1)), F.count_if(~F.col("is_deleted")), F.count_if("is_deleted"),
                F.count_if(F.col("first_seen_run_id") == run),
                F.count_if(F.col("deleted_at_run_id") == run)).first()
    live = Counter({r[0]: r[1] for r in fct.where(~F.col("is_deleted"))
                    .groupBy("source_relationship_role_code").count().collect()})
    r1 = reports.relationship_card(fct, dim, role, sort=False).count()
    r2 = Counter(r["outcome"] for r in reports.marriage_timeline(
        fct, dim, role, date, AS_OF, sort=False).collect())
    r3 = Counter(r["generations_back"] for r in reports.ancestor_lineage(
        dim, fct, sort=False).select("generations_back").collect())
    return (tuple(d), tuple(f[:3]), tuple(f[3:]), tuple(live[k] for k in ROLES), r1,
            tuple(r2[k] for k in OUTCOMES), tuple(r3[k] for k in range(1, 6)))


@pytest.fixture(scope="module")
def replay(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("demo_wh"))
    snap = G.initial(spark)
    steps = [("initial", None), ("s01", G.scenario_01), ("s02", G.scenario_02),
             ("s03_wrong", G.scenario_03_wrong), ("s03_fixed", G.scenario_03_fix)]
    seen = {}
    for i, (name, change) in enumerate(steps):
        if change is not None:
            snap = change(spark, *snap)
        # Materialise the edited graph as a real snapshot would arrive.
        snap = tuple(spark.createDataFrame(x.collect(), x.schema) for x in snap)
        run = f"run{i}"
        pipeline.run_increment(spark, root, *snap, run_id=run,
                               started_at=dt.datetime(2026, 1, 1 + i, 2))
        seen[name] = _observe(spark, root, run)
    # The same snapshot again under a new run id: nothing changes.
    pipeline.run_increment(spark, root, *snap, run_id="run_again",
                           started_at=dt.datetime(2026, 2, 1, 2))
    seen["again"] = _observe(spark, root, "run_again")
    return seen


@pytest.mark.parametrize("step", list(EXPECTED))
def test_golden_counts(replay, step):
    got = replay[step]
    exp = EXPECTED[step]
    labels = ["dim_person", "fact", "inserted/soft-deleted", "live edges by role", "R1 rows",
              "R2 outcomes", "R3 rows by depth"]
    for label, g, e in zip(labels, got, exp):
        assert g == e, f"{step}: {label} {g} != {e}"


def test_rerun_same_snapshot_changes_nothing(replay):
    before, after = replay["s03_fixed"], replay["again"]
    assert after[0] == before[0]
    assert after[1] == before[1]
    assert after[2] == (0, 0)
    assert after[3:] == before[3:]


def test_vacuum_keeps_the_newest_versions(spark, tmp_path):
    root = str(tmp_path / "wh")
    snap = G.initial(spark)
    for i, change in enumerate([None, G.scenario_01, G.scenario_02]):
        if change is not None:
            snap = change(spark, *snap)
        snap = tuple(spark.createDataFrame(x.collect(), x.schema) for x in snap)
        pipeline.run_increment(spark, root, *snap, run_id=f"v{i}",
                               started_at=dt.datetime(2026, 3, 1 + i, 2))
    wh = pipeline.Warehouse(spark, root)
    before = (wh.table("dim_person").count(), wh.table("fact_person_relationship").count())
    deleted = wh.vacuum(keep=1)
    # dim_person_current and the fact had three versions each
    assert len(deleted) == 4
    wh = pipeline.Warehouse(spark, root)
    assert (wh.table("dim_person").count(), wh.table("fact_person_relationship").count()) == before
    assert before == (42, 174)


def test_scenario_03_right_after_the_initial_load(spark, tmp_path):
    root = str(tmp_path / "wh")
    snap, seen = G.initial(spark), []
    for i, change in enumerate([None, G.scenario_03_wrong, G.scenario_03_fix]):
        if change is not None:
            snap = change(spark, *snap)
        snap = tuple(spark.createDataFrame(x.collect(), x.schema) for x in snap)
        pipeline.run_increment(spark, root, *snap, run_id=f"s{i}", started_at=dt.datetime(2026, 3, 1 + i, 2))
        seen.append(_observe(spark, root, f"s{i}")[:3])
    assert seen[1] == ((37, 37, 0), (156, 156, 0), (6, 0))
    assert seen[2] == ((37, 37, 0), (166, 160, 6), (10, 6))


def test_missing_relation_end_fails_before_any_merge(spark, tmp_path):
    from kinstar.operators.checks import ConstraintViolation
    root = str(tmp_path / "wh")
    persons, families, relations = G.initial(spark)
    bad = relations.unionByName(relations.limit(1).withColumn("family_id", F.lit(None).cast("string")))
    with pytest.raises(ConstraintViolation):
        pipeline.run_increment(spark, root, persons, families, bad, run_id="bad", started_at=dt.datetime(2026, 4, 1))
    assert pipeline.Warehouse(spark, root).table("dim_person") is None


def test_duplicate_person_id_fails_before_any_merge(spark, tmp_path):
    from kinstar.operators.checks import ConstraintViolation
    root = str(tmp_path / "wh")
    persons, families, relations = G.initial(spark)
    dup = persons.unionByName(persons.where(F.col("person_id") == "p1"))
    with pytest.raises(ConstraintViolation):
        pipeline.run_increment(spark, root, dup, families, relations, run_id="bad",
                               started_at=dt.datetime(2026, 4, 1))
    assert pipeline.Warehouse(spark, root).table("dim_person") is None  # nothing committed
