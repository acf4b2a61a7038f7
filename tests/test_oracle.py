"""Every registered query against its DuckDB oracle on the smallest test data."""

from __future__ import annotations

import pytest

from kinstar.plans.registry import ORACLE, QUERIES
from tests.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert name in ORACLE, f"{name} has no oracle"
    res = compare(df, con, ORACLE[name])
    assert res["ok"], res


def test_pipeline_tables_match_oracle_state(spark, con, tmp_path):
    """The stored warehouse after runs r1, r2 (keys included, so the
    high-water marks in the commit log are checked too)."""
    import datetime as dt

    from kinstar.plans import oracle_sql as O
    from kinstar.plans import pipeline, registry
    from kinstar.sources import fixture

    root = str(tmp_path / "wh")
    for s in (1, 2):
        pipeline.run_increment(spark, root, *fixture.snapshot(spark, SF_DIR, s), run_id=f"r{s}",
                               started_at=dt.datetime(2026, 1, s, 2))
    wh = pipeline.Warehouse(spark, root)
    dim_sql = O.with_ctes(O.state([1, 2]), f"SELECT {', '.join(registry.DIM_OUT)} FROM dim_2")
    res = compare(wh.table("dim_person").select(*registry.DIM_OUT), con, dim_sql)
    assert res["ok"], res
    fact_sql = O.with_ctes(O.state([1, 2]), f"SELECT {', '.join(O.FACT_OUT)} FROM fact_2")
    res = compare(wh.table("fact_person_relationship").select(*O.FACT_OUT), con, fact_sql)
    assert res["ok"], res
