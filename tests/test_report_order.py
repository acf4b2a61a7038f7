"""Row order and NULL placement of the reports."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kinstar.operators import dims
from kinstar.plans import registry, reports

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def wh(spark):
    dim, fact, _, role, date = registry._warehouse(spark, SF_DIR, (1, 2))[2]
    # NULLs in every sort column
    dim = dim.withColumn("last_name", F.when(F.col("person_sk") % 11 == 3, None).otherwise(F.col("last_name")))
    return dim, fact, role, date


def up(value):
    return (value is None, value if value is not None else "")


def test_relationship_card(wh):
    dim, fact, role, _ = wh
    names = {r.person_id: (r.last_name, r.first_name) for r in dim.where("is_current").collect()}
    rows = reports.relationship_card(fact, dim, role).collect()
    keys = [(*map(up, names[r.person_id]), up(r.relationship_type), up(r.role),
             (r.related_birth_date is None, r.related_birth_date or dt.date.min)) for r in rows]
    assert keys == sorted(keys) and any(k[0][0] for k in keys) and any(k[4][0] for k in keys)


def test_marriage_timeline(wh):
    dim, fact, role, date = wh
    rows = reports.marriage_timeline(fact, dim, role, date, dt.date(2026, 6, 30)).collect()
    keys = [(r.marriage_date is None, r.marriage_date or dt.date.min) for r in rows]
    assert keys == sorted(keys) and keys[-1][0] and not keys[0][0]


def test_ancestor_lineage(wh):
    dim, fact, *_ = wh
    rows = reports.ancestor_lineage(dim, fact).collect()
    keys = [(r.person_birth_date is None, -(r.person_birth_date or dt.date.min).toordinal(), up(r.person), r.generations_back) for r in rows]
    assert keys == sorted(keys) and keys[-1][0] and dims.role_rows
