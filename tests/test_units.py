
from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from kinstar.functions import (
    attr_hash,
    full_name,
    generation_label,
    marriage_end_reason,
    spouse_role_code,
    year_boundaries_between,
)
from kinstar.operators import checks, closure, dims, kinship
from kinstar.operators.keys import with_surrogate_key
from kinstar.sources import fixture, graph, store

D = dt.date


def test_year_boundaries_not_complete_years(spark):
    df = spark.createDataFrame([(D(2019, 12, 31), D(2020, 1, 1)), (D(2000, 6, 1), D(2000, 5, 1)),
                                (D(1999, 1, 1), D(2026, 12, 31))], "a date, b date")
    got = [r[0] for r in df.select(year_boundaries_between("a", "b")).collect()]
    assert got == [1, 0, 27]


def test_generation_label(spark):
    df = spark.range(1, 7).select(generation_label(F.col("id")).alias("l"))
    assert [r.l for r in df.collect()] == [
        "Parent", "Grandparent", "Great-grandparent", "Great-great-grandparent",
        "Great-great-great-grandparent", "Great-great-great-great-grandparent"]


def test_full_name_is_null_when_a_part_is_null(spark):
    df = spark.createDataFrame([("A", "B"), (None, "B"), ("A", None)], "f string, l string")
    assert [r[0] for r in df.select(full_name("f", "l")).collect()] == ["A B", None, None]


def test_attr_hash_null_equals_empty(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x"), ("a|b", "c"), ("a", "b|c")], "a string, b string")
    h = [r[0] for r in df.select(attr_hash("a", "b")).collect()]
    assert h[0] == h[1]
    assert h[2] == h[3]  # the '|' collision is part of the contract


def test_codes(spark):
    df = spark.createDataFrame(
        [("HUSBAND", None, "ACTIVE"), ("WIFE", D(2020, 1, 1), "ACTIVE"), ("NONE", None, "ended"),
         ("PARTNER", None, "widowed"), ("X", None, None)], "r string, d date, s string")
    got = [tuple(r) for r in df.select(spouse_role_code("r"), marriage_end_reason("d", "s")).collect()]
    assert got == [("SPOUSE_HUSBAND", None), ("SPOUSE_WIFE", "DIVORCE"),
                   ("SPOUSE_PARTNER", "STATUS_ENDED"), ("SPOUSE_PARTNER", None),
                   ("SPOUSE_PARTNER", None)]


def test_calendar(spark):
    cal = dims.date_dimension(spark)
    assert cal.count() == 73414
    rows = {r.full_date: r for r in cal.where(F.col("full_date").isin(
        D(2024, 2, 29), D(2026, 12, 6), D(2026, 12, 4), D(1900, 1, 1))).collect()}
    leap = rows[D(2024, 2, 29)]
    assert (leap.date_sk, leap.day_name, leap.day_of_week, leap.is_weekend) == (20240229, "Thursday", 4, False)
    assert (rows[D(2026, 12, 4)].day_name, rows[D(2026, 12, 4)].is_weekend) == ("Friday", True)
    assert (rows[D(2026, 12, 6)].day_of_week, rows[D(2026, 12, 6)].is_weekend) == (0, False)
    assert rows[D(1900, 1, 1)].month_name == "January"


def test_role_seed_is_idempotent(spark):
    first = dims.role_dimension(spark)
    assert [r.relationship_role_sk for r in first.orderBy("relationship_role_sk").collect()] == list(range(1, 8))
    again = dims.role_dimension(spark, first)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, first.collect()))


@pytest.mark.parametrize("parts", [None, 1, 5])
def test_surrogate_keys_follow_natural_order(spark, parts):
    ids = [f"k{(i * 7919) % 1000:04d}" for i in range(1000)]
    df = spark.createDataFrame([(i,) for i in ids], "k string").repartition(7)
    got = with_surrogate_key(df, ["k"], "sk", start=41, num_partitions=parts).collect()
    assert sorted((r.sk, r.k) for r in got) == list(zip(range(42, 1042), sorted(ids)))


def test_sibling_blocks_give_the_same_pairs(spark):
    # one parent with 9 children, another with 2, a third sharing two kids
    rows = [("P", f"c{i}", D(2000 + i, 1, 1)) for i in range(9)]
    rows += [("Q", "c1", D(2001, 1, 1)), ("Q", "c2", D(2002, 1, 1)), ("R", "x", None), ("R", "y", None)]
    pcm = spark.createDataFrame(rows, "parent_id string, child_id string, child_birth_date date")
    plain = sorted(map(tuple, kinship.sibling_pairs(pcm, block_size=10_000).collect()))
    blocked = sorted(map(tuple, kinship.sibling_pairs(pcm, block_size=2).collect()))
    assert plain == blocked
    assert len(plain) == 36 + 1
    assert dict(((a, b), n) for a, b, n, *_ in plain)[("c1", "c2")] == 2


def test_closure_raises_on_a_cycle(spark):
    base = spark.createDataFrame([("a", "a", 0)], "root string, node string, depth int")
    edges = spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string")
    with pytest.raises(closure.CycleError):
        closure.closure(base, edges, "root", "node", "src", "dst", {})


def test_closure_raises_on_a_cycle_that_lies_beyond_its_root(spark):
    # x -> a -> b -> c -> a; every person is a root, x is not on the cycle
    base = spark.createDataFrame([(n, n, 0) for n in "xabc"], "root string, node string, depth int")
    edges = spark.createDataFrame([("x", "a"), ("a", "b"), ("b", "c"), ("c", "a")], "src string, dst string")
    with pytest.raises(closure.CycleError):
        closure.closure(base, edges, "root", "node", "src", "dst", {})


def test_closure_has_no_depth_limit():
    import inspect
    from kinstar.plans import reports
    for fn in (closure.closure, reports.ancestor_closure):
        assert not any("depth" in p and p != "depth_col" for p in inspect.signature(fn).parameters)


def test_closure_counts_paths(spark):
    # diamond: d -> b, d -> c, b -> a, c -> a : two paths from d to a
    base = spark.createDataFrame([("d", "d", 0)], "root string, node string, depth int")
    edges = spark.createDataFrame([("d", "b"), ("d", "c"), ("b", "a"), ("c", "a")], "src string, dst string")
    out = closure.closure(base, edges, "root", "node", "src", "dst", {})
    assert sorted((r.node, r.depth) for r in out.collect()) == [
        ("a", 2), ("a", 2), ("b", 1), ("c", 1), ("d", 0)]


def test_bad_date_fails_the_run(spark):
    nodes = spark.createDataFrame([({"id": "p1", "birth_date": "not a date"},)], "props map<string,string>")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(Exception, match="birth_date is not a date"):
                graph.person_nodes(nodes).collect()
        finally:
            spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_read_graph(spark, scratch, fmt):
    props = "props map<string,string>"
    spark.createDataFrame([({"id": "p1", "birth_date": "1990-05-01", "hobby": "x"},), ({"id": "p2"},)], props).write.format(fmt).save(f"{scratch}/person")
    spark.createDataFrame([({"id": "f1", "status": "ACTIVE"},)], props).write.format(fmt).save(f"{scratch}/family")
    spark.createDataFrame([("p1", "f1", "SPOUSE_OF", {"role": "HUSBAND"}), ("p2", "f1", "CHILD_OF", {}), ("p9", "f1", "CHILD_OF", {})],
                          f"person_id string, family_id string, relationship_type string, {props}").write.format(fmt).save(f"{scratch}/relation")
    person, family, relation = graph.read_graph(spark, scratch, fmt)
    assert sorted((r.person_id, str(r.birth_date)) for r in person.collect()) == [("p1", "1990-05-01"), ("p2", "None")]
    assert [r.status for r in family.collect()] == ["ACTIVE"]
    assert sorted(map(tuple, relation.collect())) == [("p1", "f1", "SPOUSE_OF", "HUSBAND"), ("p2", "f1", "CHILD_OF", None)]
    with pytest.raises(ValueError):
        graph.read_graph(spark, scratch, "csv")


def test_missing_property_is_null_and_extras_dropped(spark):
    nodes = spark.createDataFrame([({"id": "p1", "hobby": "chess"},)], "props map<string,string>")
    r = graph.person_nodes(nodes).first()
    assert r.person_id == "p1" and r.first_name is None and "hobby" not in r.asDict()


def test_shape_check(spark):
    with pytest.raises(graph.ShapeError):
        graph.person_nodes(spark.createDataFrame([("x",)], "props string"))


def test_dangling_edges_dropped(spark):
    persons = spark.createDataFrame([("p1",)], "person_id string")
    families = spark.createDataFrame([("f1",)], "family_id string")
    edges = spark.createDataFrame(
        [("p1", "f1", "SPOUSE_OF", {"role": "HUSBAND"}), ("p2", "f1", "CHILD_OF", {}),
         ("p1", "f9", "CHILD_OF", {})],
        "person_id string, family_id string, relationship_type string, props map<string,string>")
    got = [tuple(r) for r in graph.relations(edges, persons, families).collect()]
    assert got == [("p1", "f1", "SPOUSE_OF", "HUSBAND")]


def test_key_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", None)], "k string, v int")
    s = checks.key_summary(df, "t", ["k"], ["v"]).first()
    assert (s.n_rows, s.n_keys, s.n_null_keys, s.n_duplicate_keys, s.n_not_null_violations) == (4, 3, 1, 1, 1)
    with pytest.raises(checks.ConstraintViolation):
        checks.assert_valid(checks.key_summary(df, "t", ["k"]))


def test_staging_store_and_current_run(spark, scratch):
    person = spark.createDataFrame([("p1", "A", "B", "Male", None, None, "e", "w")],
                                   "person_id string, first_name string, last_name string, sex string, "
                                   "birth_date date, death_date date, education string, works string")
    t = dt.datetime(2026, 1, 1, 2)
    for run in ("a", "b"):
        store.write_snapshot(scratch, "raw_person_snapshot", person, run)
        store.write_run_log(spark, scratch, run, t)  # same start: tie broken by run id
    log = store.read_raw(spark, scratch, store.RUN_LOG_TABLE)
    assert store.resolve_current_run(log) == "b"
    raw = store.read_raw(spark, scratch, "raw_person_snapshot")
    assert store.snapshot_slice(raw, "b").count() == 1
    # a missing staging table reads as empty with the fixed schema
    assert store.read_raw(spark, scratch, "raw_family_snapshot").count() == 0


def test_changeset_update_removes_with_null(spark):
    from kinstar.operators import changeset
    nodes = spark.createDataFrame([Row(person_id="p1", works="x", sex="M")])
    ch = spark.createDataFrame([("p1", None), ("p9", "y")], "person_id string, works string")
    got = changeset.update_properties(nodes, ch, "person_id").collect()
    assert [tuple(r) for r in got] == [("p1", None, "M")]


def test_spouse_blocks_give_the_same_edges(spark):
    rows = [(f"s{i}", "F1", ["HUSBAND", "WIFE", "NONE"][i % 3], D(1950, 1, 1), None, "ended")
            for i in range(7)]
    rows += [("s1", "F1", "WIFE", D(1950, 1, 1), None, "ended"),  # same person twice
             ("a", "F2", "HUSBAND", None, D(2000, 1, 1), "ACTIVE"), ("b", "F2", "WIFE", None, D(2000, 1, 1), "ACTIVE")]
    sp = spark.createDataFrame(rows, "person_id string, family_id string, role string, "
                                     "marriage_date date, divorce_date date, status string")
    plain = sorted(map(tuple, kinship.spouse_edges(sp, block_size=10_000).collect()))
    blocked = sorted(map(tuple, kinship.spouse_edges(sp, block_size=2).collect()))
    assert plain == blocked
    # reference form: ordered pairs of different persons, role of the source
    want = set()
    for p, f, r, m, d, st in rows:
        for q, g, *_ in rows:
            if f == g and p != q:
                code = {"HUSBAND": "SPOUSE_HUSBAND", "WIFE": "SPOUSE_WIFE"}.get(r, "SPOUSE_PARTNER")
                reason = "DIVORCE" if d else ("STATUS_ENDED" if st.upper() in ("DIVORCED", "ENDED") else None)
                want.add((p, q, code, m, d, reason))
    assert set(plain) == want and len(plain) == len(want)


def test_marriage_timeline_defaults_to_current_date(spark):
    from kinstar.plans import reports
    dim = spark.createDataFrame(
        [(1, "h", "A", "B", None, None, True), (2, "w", "C", "D", None, None, True)],
        "person_sk long, person_id string, first_name string, last_name string, "
        "birth_date date, death_date date, is_current boolean")
    role = dims.role_dimension(spark)
    fact = spark.createDataFrame(
        [(1, 2, 1, "SPOUSE_HUSBAND", D(2000, 6, 1), None, None, False)],
        "source_person_sk long, target_person_sk long, relationship_role_sk long, "
        "source_relationship_role_code string, start_date date, end_date date, "
        "end_reason string, is_deleted boolean")
    cal = dims.date_dimension(spark)
    r = reports.marriage_timeline(fact, dim, role, cal).first()
    assert r.outcome == "Active" and r.marriage_year == 2000
    assert r.years_together == dt.date.today().year - 2000
    fixed = reports.marriage_timeline(fact, dim, role, cal, D(2026, 6, 30)).first()
    assert fixed.years_together == 26


def test_persons_and_families_are_not_broadcast_however_small_their_files(spark, scratch):
    spark.range(1, 2000).select(F.col("id").alias("c_custkey"), F.lit(3).alias("c_nationkey"), F.lit("A").alias("c_mktsegment")).write.parquet(f"{scratch}/customer.parquet")
    person, family, relation = fixture.snapshot(spark, scratch, 1)
    spouses, children = kinship.spouse_relation(relation, family), kinship.child_relation(relation, person)
    edges = kinship.parent_edges(kinship.parent_child(spouses, children))
    dim = person.select("person_id", F.expr("cast(substr(person_id, 2) as long)").alias("person_sk"), F.lit(True).alias("is_current"))
    enriched = kinship.enrich_edges(edges, dim, dims.role_dimension(spark), dims.seed_calendar(spark))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    for df in (relation, spouses, children, kinship.parent_child(spouses, children)):
        assert "SortMergeJoin" in plan(df) and "BroadcastHashJoin" not in plan(df)
    for side in ("source", "target"):
        assert any("SortMergeJoin" in line and f"{side}_person_id" in line for line in plan(enriched).splitlines())
    assert enriched.count() == edges.count() > 0
    assert enriched.where("source_person_sk <> cast(substr(source_person_id, 2) as long)").isEmpty()
