"""The six-generation demo family graph and its three change scenarios.

Ids, sexes, dates, memberships and which attributes change are the fixed
values that decide every expected count (FIXTURES.md §2); names and the
education / work texts are placeholders.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from kinstar.schemas import FAMILY, PERSON, RELATION


def _d(s: str | None) -> dt.date | None:
    return dt.date.fromisoformat(s) if s else None


# Person id, sex, birth date, death date.
PERSONS = [
    ("p1", "Male", "1880-01-01", "1962-01-01"), ("p2", "Female", "1885-01-01", "1966-01-01"),
    ("p3", "Female", "1899-01-01", "1950-01-01"), ("p4", "Male", "1890-01-01", "1977-01-01"),
    ("p5", "Female", "1912-01-01", "2010-01-01"), ("p6", "Male", "1908-01-01", "1991-01-01"),
    ("p7", "Male", "1918-01-01", "2003-01-01"), ("p8", "Female", "1920-01-01", "1989-01-01"),
    ("p9", "Female", "1950-01-01", None), ("p10", "Male", "1945-01-01", "2022-01-01"),
    ("p11", "Female", "1955-01-01", None), ("p12", "Female", "1960-01-01", None),
    ("p13", "Male", "1962-01-01", None), ("p14", "Male", "1940-01-01", "2020-01-01"),
    ("p15", "Female", "1978-01-01", None), ("p16", "Male", "1970-01-01", None),
    ("p17", "Male", "1975-01-01", None), ("p18", "Female", "1973-01-01", "2018-01-01"),
    ("p19", "Male", "1985-01-01", None), ("p20", "Female", "1985-01-01", None),
    ("p21", "Female", "1983-01-01", None), ("p22", "Female", "1988-01-01", None),
    ("p23", "Male", "1970-01-01", None), ("p24", "Female", "1975-01-01", None),
    ("p25", "Female", "2002-01-01", None), ("p26", "Male", "2002-01-01", None),
    ("p27", "Female", "2001-01-01", None), ("p28", "Male", "2003-01-01", None),
    ("p29", "Male", "2005-01-01", None), ("p30", "Female", "2012-01-01", None),
    ("p31", "Female", "2009-01-01", None), ("p32", "Female", "2001-01-01", None),
    ("p33", "Male", "2002-01-01", None), ("p34", "Male", "2010-01-01", None),
    ("p35", "Male", "2021-01-01", None), ("p36", "Male", "2021-01-01", None),
]
# Family id, marriage date, divorce date, status.
FAMILIES = [
    ("f1", "1910-06-01", None, "WIDOWED"), ("f2", "1919-09-15", None, "WIDOWED"),
    ("f3", "1935-04-20", None, "WIDOWED"), ("f4", "1939-11-10", None, "WIDOWED"),
    ("f5", "1969-07-07", None, "WIDOWED"), ("f6", "1970-05-05", None, "WIDOWED"),
    ("f7", "1984-08-20", None, "ACTIVE"), ("f8", "2000-02-14", None, "ACTIVE"),
    ("f9", "2008-06-10", "2011-01-01", "DIVORCED"), ("f10", "2012-03-30", None, "ACTIVE"),
    ("f11", "1995-11-22", None, "ACTIVE"), ("f12", "2020-09-09", None, "ACTIVE"),
]
# Fixed values: (husband, wife, family).
COUPLES = [
    ("p1", "p2", "f1"), ("p4", "p3", "f2"), ("p6", "p5", "f3"), ("p7", "p8", "f4"),
    ("p14", "p9", "f5"), ("p10", "p11", "f6"), ("p13", "p12", "f7"), ("p16", "p15", "f8"),
    ("p19", "p20", "f9"), ("p19", "p21", "f10"), ("p23", "p24", "f11"), ("p26", "p25", "f12"),
]
# Family -> children.
CHILDREN = {
    "f1": ["p7"], "f2": ["p8"], "f3": ["p9"], "f4": ["p10", "p12", "p14"],
    "f5": ["p22", "p23"], "f6": ["p15", "p17", "p18"], "f7": ["p19"],
    "f8": ["p27", "p28", "p29"], "f9": ["p26"], "f10": ["p30", "p31"],
    "f11": ["p32", "p33", "p34"], "f12": ["p35", "p36"],
}


def person_row(pid, sex, birth, death=None, edu=None, work=None):
    n = pid[1:]
    return (pid, f"Given{n}", f"Line{int(n) % 7}", sex, _d(birth), _d(death),
            edu or f"edu-{n}", work or f"work-{n}")


def initial(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    persons = spark.createDataFrame([person_row(*p) for p in PERSONS], PERSON)
    families = spark.createDataFrame(
        [(f, _d(m), _d(d), s) for f, m, d, s in FAMILIES], FAMILY)
    rel = []
    for h, w, f in COUPLES:
        rel += [(h, f, "SPOUSE_OF", "HUSBAND"), (w, f, "SPOUSE_OF", "WIFE")]
    for f, kids in CHILDREN.items():
        rel += [(k, f, "CHILD_OF", None) for k in kids]
    return persons, families, spark.createDataFrame(rel, RELATION)


def scenario_01(spark, persons, families, relations):
    """Two births (p37 -> f10, p38 -> f8); p17 marries new person p39 (f13)."""
    from kinstar.operators import changeset as cs
    new_p = spark.createDataFrame([
        person_row("p37", "Male", "2026-01-15"), person_row("p38", "Female", "2025-06-20"),
        person_row("p39", "Female", "1978-03-10")], PERSON)
    persons = cs.insert_nodes_if_absent(persons, new_p, "person_id")
    families = cs.insert_nodes_if_absent(
        families, spark.createDataFrame([("f13", _d("2006-08-18"), None, "ACTIVE")], FAMILY),
        "family_id")
    new_e = spark.createDataFrame([
        ("p37", "f10", "CHILD_OF", None), ("p38", "f8", "CHILD_OF", None),
        ("p17", "f13", "SPOUSE_OF", "HUSBAND"), ("p39", "f13", "SPOUSE_OF", "WIFE")], RELATION)
    return persons, families, cs.insert_edges_if_absent(relations, new_e, persons, families)


def scenario_02(spark, persons, families, relations):
    """p9 dies; f8 divorces; p27 changes education and work; p22 changes work."""
    from kinstar.operators import changeset as cs
    persons = cs.update_properties(persons, spark.createDataFrame(
        [("p9", _d("2026-02-10"))], "person_id string, death_date date"), "person_id")
    persons = cs.update_properties(persons, spark.createDataFrame(
        [("p27", "edu-27b", "work-27b")], "person_id string, education string, works string"),
        "person_id")
    persons = cs.update_properties(persons, spark.createDataFrame(
        [("p22", "work-22b")], "person_id string, works string"), "person_id")
    families = cs.update_properties(families, spark.createDataFrame(
        [("f8", "DIVORCED", _d("2026-03-01"))], "family_id string, status string, divorce_date date"),
        "family_id")
    return persons, families, relations


def scenario_03_wrong(spark, persons, families, relations):
    """New child p40, linked by mistake to f7."""
    from kinstar.operators import changeset as cs
    persons = cs.insert_nodes_if_absent(
        persons, spark.createDataFrame([person_row("p40", "Male", "2015-07-04")], PERSON), "person_id")
    rel = cs.insert_edges_if_absent(
        relations, spark.createDataFrame([("p40", "f7", "CHILD_OF", None)], RELATION),
        persons, families)
    return persons, families, rel


def scenario_03_fix(spark, persons, families, relations):
    """Move p40 from f7 to f8."""
    from kinstar.operators import changeset as cs
    rel = cs.delete_edges(relations, spark.createDataFrame(
        [("p40", "f7", "CHILD_OF", None)], RELATION))
    rel = cs.insert_edges_if_absent(
        rel, spark.createDataFrame([("p40", "f8", "CHILD_OF", None)], RELATION), persons, families)
    return persons, families, rel
