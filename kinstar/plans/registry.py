"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame`` plus oracle SQL.

Inputs are the kinship snapshots derived from ``customer`` (runs r1, r2 and
r3 = r1 replayed) and, for the volume checks, ``orders`` and ``lineitem``.
Every query reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinstar.operators import changeset, checks, diff, digest, dims, kinship, profile, scd2
from kinstar.operators import fact as fact_ops
from kinstar.plans import oracle_sql as O
from kinstar.plans import pipeline, reports
from kinstar.schemas import PERSON_TRACKED, RUN_LOG
from kinstar.session import materialize, scratch_path
from kinstar.sources import fixture, graph, store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _tag(df: DataFrame, seq: int) -> DataFrame:
    return df.select(F.lit(O.run_name(seq)).alias("run_id"), *df.columns)


def _both(build: Callable[[int], DataFrame]) -> DataFrame:
    return _tag(build(1), 1).unionByName(_tag(build(2), 2))


def _union_sql(select_for: Callable[[int], str]) -> str:
    return f"{select_for(1)}\nUNION ALL\n{select_for(2)}"


FIX = O.fixture(1) + O.fixture(2)
KIN = FIX + O.kinship(1) + O.kinship(2)


# --- extraction (IO1-IO7) ----------------------------------------------------------

def _extracted(spark: SparkSession, sf_dir: str, seq: int):
    """Derived snapshot -> property-bag graph -> projected staging rows."""
    person, family, relation = fixture.snapshot(spark, sf_dir, seq)
    pnodes = graph.to_property_bag(person, graph.PERSON_PROPS)
    fnodes = graph.to_property_bag(family, graph.FAMILY_PROPS)
    edges = relation.select("person_id", "family_id", "relationship_type",
                            F.create_map(F.lit("role"), F.col("role")).alias("props"))
    persons = graph.person_nodes(pnodes)
    families = graph.family_nodes(fnodes)
    return persons, families, graph.relations(edges, persons, families)


@register("extract_person", O.with_ctes(FIX, _union_sql(
    lambda s: f"SELECT 'r{s}' AS run_id, * FROM person_{s}")))
def q_extract_person(spark, sf_dir):
    return _both(lambda s: _extracted(spark, sf_dir, s)[0])


@register("extract_family", O.with_ctes(FIX, _union_sql(
    lambda s: f"SELECT 'r{s}' AS run_id, * FROM family_{s}")))
def q_extract_family(spark, sf_dir):
    return _both(lambda s: _extracted(spark, sf_dir, s)[1])


@register("extract_relation", O.with_ctes(FIX, _union_sql(
    lambda s: f"SELECT 'r{s}' AS run_id, r.* FROM relation_{s} r "
              f"WHERE r.family_id IN (SELECT family_id FROM family_{s})")))
def q_extract_relation(spark, sf_dir):
    return _both(lambda s: _extracted(spark, sf_dir, s)[2])


# --- kinship edges (E1-E7) ---------------------------------------------------------

def _snap(spark, sf_dir, seq):
    return fixture.snapshot(spark, sf_dir, seq)


@register("spouse_relation", O.with_ctes(KIN, _union_sql(
    lambda s: f"SELECT 'r{s}' AS run_id, * FROM spouse_rel_{s}")))
def q_spouse_relation(spark, sf_dir):
    def build(s):
        _, family, relation = _snap(spark, sf_dir, s)
        return kinship.spouse_relation(relation, family)
    return _both(build)


@register("spouse_edges", O.with_ctes(KIN, _union_sql(
    lambda s: f"SELECT 'r{s}' AS run_id, * FROM spouse_edge_{s}")))
def q_spouse_edges(spark, sf_dir):
    def build(s):
        _, family, relation = _snap(spark, sf_dir, s)
        return kinship.spouse_edges(kinship.spouse_relation(relation, family))
    return _both(build)


def _pc(spark, sf_dir, s):
    person, family, relation = _snap(spark, sf_dir, s)
    sp = kinship.spouse_relation(relation, family)
    return kinship.parent_child(sp, kinship.child_relation(relation, person))


@register("parent_edges", O.with_ctes(KIN, _union_sql(
    lambda s: f"SELECT 'r{s}' AS run_id, * FROM parent_edge_{s}")))
def q_parent_edges(spark, sf_dir):
    return _both(lambda s: kinship.parent_edges(_pc(spark, sf_dir, s)))


@register("child_edges", O.with_ctes(KIN, _union_sql(
    lambda s: f"SELECT 'r{s}' AS run_id, * FROM child_edge_{s}")))
def q_child_edges(spark, sf_dir):
    return _both(lambda s: kinship.child_edges(_pc(spark, sf_dir, s)))


@register("parent_child_map", O.with_ctes(KIN, _union_sql(
    lambda s: f"SELECT 'r{s}' AS run_id, * FROM pcm_{s}")))
def q_parent_child_map(spark, sf_dir):
    return _both(lambda s: kinship.parent_child_map(_pc(spark, sf_dir, s))
                 .select("parent_id", "child_id"))


@register("sibling_pairs", O.with_ctes(KIN, _union_sql(
    lambda s: f"SELECT 'r{s}' AS run_id, person_a, person_b, shared_parent_count FROM sib_pair_{s}")))
def q_sibling_pairs(spark, sf_dir):
    return _both(lambda s: kinship.sibling_pairs(kinship.parent_child_map(_pc(spark, sf_dir, s)))
                 .select("person_a", "person_b", "shared_parent_count"))


@register("sibling_edges", O.with_ctes(KIN, _union_sql(
    lambda s: f"SELECT 'r{s}' AS run_id, * FROM sib_edge_{s}")))
def q_sibling_edges(spark, sf_dir):
    return _both(lambda s: kinship.sibling_edges(
        kinship.sibling_pairs(kinship.parent_child_map(_pc(spark, sf_dir, s)))))


@register("combined_edges", O.with_ctes(KIN, _union_sql(
    lambda s: f"SELECT 'r{s}' AS run_id, * FROM edge_{s}")))
def q_combined_edges(spark, sf_dir):
    return _both(lambda s: kinship.derive_edges(*_snap(spark, sf_dir, s)))


# --- dimensions, diff, SCD-2, fact, reports ------------------------------------------



AS_OF = _dt.date.fromisoformat(O.AS_OF_DATE)
DIM_OUT = ["person_sk", "person_id", *PERSON_TRACKED, "attr_hash", "valid_from_run_id",
           "valid_to_run_id", "is_current", "is_deleted"]


def _started(seq: int) -> _dt.datetime:
    return _dt.datetime.fromisoformat(O.RUN_STARTS[seq])


def _content(seq: int) -> int:
    return 1 if seq == 3 else seq


def _warehouse(spark, sf_dir, seqs=(1, 2)):
    """Run the derived snapshots through the merges; per run:
    (dim_person, fact, edges, dim_role, dim_date). Each version is
    checkpointed, as a stored table version would be."""
    dim_role = materialize(dims.role_dimension(spark))
    dim_date = materialize(dims.seed_calendar(spark))
    dim = fct = None
    out = {}
    for s in seqs:
        person, family, relation = fixture.snapshot(spark, sf_dir, _content(s))
        run = O.run_name(s)
        dim = materialize(scd2.scd2_merge(dim, person, run, _started(s), key="person_id",
                                          tracked=PERSON_TRACKED, sk_col="person_sk"))
        edges = kinship.derive_edges(person, family, relation)
        flagged = kinship.enrich_edges(edges, dim, dim_role, dim_date, keep_unmatched=True)
        fct = materialize(fact_ops.merge_fact(fct, flagged, run, _started(s)))
        out[s] = (dim, fct, edges, dim_role, dim_date)
    return out


ROLE_COLS = ["relationship_role_sk", "relationship_role_code", "relationship_type",
             "person_role", "is_symmetric", "inverse_role_code"]


@register("dim_role", O.with_ctes(FIX + O.kinship(1) + [O.dim_role()],
                                  "SELECT * FROM dim_role"))
def q_dim_role(spark, sf_dir):
    # The table already holds the roles observed in r1's edges; seeding adds
    # whatever is missing and never touches existing rows.
    observed = kinship.derive_edges(*fixture.snapshot(spark, sf_dir, 1)).select(
        "relationship_role_code").distinct()
    existing = dims.role_dimension(spark).join(observed, "relationship_role_code", "left_semi")
    return dims.role_dimension(spark, existing).select(*ROLE_COLS)


DATE_COLS = ["date_sk", "full_date", "day_of_month", "month_of_year", "month_name",
             "quarter_of_year", "year_num", "day_of_week", "day_name", "is_weekend"]


@register("dim_date", O.with_ctes(
    [O.dim_date(), f"""partial AS (
  {O.calendar_select('d', "(SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_shipdate IS NOT NULL) s")})"""],
    "SELECT * FROM partial UNION ALL SELECT * FROM dim_date "
    "WHERE full_date NOT IN (SELECT full_date FROM partial)"))
def q_dim_date(spark, sf_dir):
    # Existing table = the days the line items ship on; the seed adds the rest.
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    existing = dims.dates_dimension_of(line, "l_shipdate")
    return dims.seed_calendar(spark, existing).select(*DATE_COLS)


@register("seed_if_absent", O.with_ctes(FIX, """
SELECT row_number() OVER (ORDER BY person_id) AS person_sk, * FROM person_1
UNION ALL
SELECT (SELECT count(*) FROM person_1) + row_number() OVER (ORDER BY person_id), *
FROM person_2 WHERE person_id NOT IN (SELECT person_id FROM person_1)"""))
def q_seed_if_absent(spark, sf_dir):
    cust = fixture.read_customer(spark, sf_dir)
    p1, p2 = fixture.person_snapshot(cust, 1), fixture.person_snapshot(cust, 2)
    t = dims.seed_if_absent(None, p1, ["person_id"], sk_col="person_sk")
    t = dims.seed_if_absent(t, p2, ["person_id"], sk_col="person_sk")
    t = dims.seed_if_absent(t, p2, ["person_id"], sk_col="person_sk")  # second seed: no-op
    return t.select("person_sk", *p1.columns)


@register("attr_hash", O.with_ctes(FIX, _union_sql(
    lambda s: f"SELECT 'r{s}' AS run_id, person_id, {O.md5_sql()} AS attr_hash FROM person_{s}")))
def q_attr_hash(spark, sf_dir):
    cust = fixture.read_customer(spark, sf_dir)
    return _both(lambda s: diff.with_attr_hash(fixture.person_snapshot(cust, s), PERSON_TRACKED)
                 .select("person_id", "attr_hash"))


@register("snapshot_diff", O.with_ctes(FIX, f"""
SELECT coalesce(a.person_id, b.person_id) AS person_id,
       CASE WHEN a.person_id IS NULL THEN 'new' WHEN b.person_id IS NULL THEN 'deleted'
            WHEN {O.md5_sql('a')} IS DISTINCT FROM {O.md5_sql('b')} THEN 'changed'
            ELSE 'same' END AS change_type
FROM person_1 a FULL OUTER JOIN person_2 b ON a.person_id = b.person_id"""))
def q_snapshot_diff(spark, sf_dir):
    cust = fixture.read_customer(spark, sf_dir)
    return diff.snapshot_diff(fixture.person_snapshot(cust, 1), fixture.person_snapshot(cust, 2),
                              ["person_id"], PERSON_TRACKED)


ORDER_TRACKED = ["o_orderstatus", "o_orderdate", "o_orderpriority"]


def _orders_prev_cur(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    k = F.col("o_orderkey")
    prev = o.where(k % 40 != 9)
    cur = o.where(k % 50 != 7).withColumn(
        "o_orderstatus", F.when(k % 10 == 3, F.lit("X")).otherwise(F.col("o_orderstatus")))
    return prev, cur


def _orders_hash(a: str) -> str:
    return (f"md5(coalesce({a}.o_orderstatus, '') || '|' || coalesce(CAST({a}.o_orderdate AS VARCHAR), '')"
            f" || '|' || coalesce({a}.o_orderpriority, ''))")


@register("snapshot_diff_orders", f"""
WITH prev AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
              FROM orders WHERE o_orderkey % 40 <> 9),
     cur AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 3 THEN 'X' ELSE o_orderstatus END
                      AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
             FROM orders WHERE o_orderkey % 50 <> 7)
SELECT coalesce(p.o_orderkey, c.o_orderkey) AS o_orderkey,
       CASE WHEN p.o_orderkey IS NULL THEN 'new' WHEN c.o_orderkey IS NULL THEN 'deleted'
            WHEN {_orders_hash('p')} IS DISTINCT FROM {_orders_hash('c')} THEN 'changed'
            ELSE 'same' END AS change_type,
       p.o_totalprice AS prev_o_totalprice, c.o_totalprice AS cur_o_totalprice
FROM prev p FULL OUTER JOIN cur c ON p.o_orderkey = c.o_orderkey""")
def q_snapshot_diff_orders(spark, sf_dir):
    prev, cur = _orders_prev_cur(spark, sf_dir)
    return diff.snapshot_diff(prev, cur, ["o_orderkey"], ORDER_TRACKED, carry=["o_totalprice"])


@register("snapshot_diff_by_leaves", f"""
WITH top AS (SELECT max(o_orderkey) AS k FROM orders),
     prev AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders),
     cur AS (SELECT o_orderkey, CASE WHEN 10 * o_orderkey > 9 * k THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
                    o_totalprice, o_orderdate, o_orderpriority FROM orders, top WHERE 100 * o_orderkey <= 99 * k)
SELECT coalesce(p.o_orderkey, c.o_orderkey) AS o_orderkey,
       CASE WHEN p.o_orderkey IS NULL THEN 'new' WHEN c.o_orderkey IS NULL THEN 'deleted'
            WHEN {_orders_hash('p')} IS DISTINCT FROM {_orders_hash('c')} THEN 'changed'
            ELSE 'same' END AS change_type,
       p.o_totalprice AS prev_o_totalprice, c.o_totalprice AS cur_o_totalprice
FROM prev p FULL OUTER JOIN cur c ON p.o_orderkey = c.o_orderkey""")
def q_snapshot_diff_by_leaves(spark, sf_dir):
    """The newest tenth of the orders change, and of these the newest tenth goes."""
    prev = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    top, k = prev.agg(F.max("o_orderkey")).first()[0] or 0, F.col("o_orderkey")
    cur = prev.where(k * 100 <= 99 * top).withColumn(
        "o_orderstatus", F.when(k * 10 > 9 * top, F.lit("X")).otherwise(F.col("o_orderstatus")))
    leaf = F.floor(k / (top // digest.LEAVES + 1))
    return diff.snapshot_diff_by_leaves(prev, cur, ["o_orderkey"], ORDER_TRACKED, carry=["o_totalprice"], leaf=leaf)


def _raw_person(spark, sf_dir):
    """Raw person staging table (all runs) and its run log, both derived."""
    cust = fixture.read_customer(spark, sf_dir)
    raw = _both(lambda s: fixture.person_snapshot(cust, s))
    log = raw.select("run_id").distinct().select(
        "run_id",
        (F.lit(_started(1)).cast("timestamp_ntz")
         + F.make_dt_interval(F.substring("run_id", 2, 9).cast("int") - 1)).alias("started_at"))
    return raw, log


RAW_LOG_SQL = [*FIX, """raw_person AS (
  SELECT 'r1' AS run_id, * FROM person_1 UNION ALL SELECT 'r2' AS run_id, * FROM person_2)""",
               """run_log AS (
  SELECT run_id, TIMESTAMP '2026-01-01 02:00:00'
         + to_days(CAST(substr(run_id, 2) AS INTEGER) - 1) AS started_at
  FROM (SELECT DISTINCT run_id FROM raw_person) r)"""]


@register("current_run", O.with_ctes(
    RAW_LOG_SQL, "SELECT run_id, started_at FROM run_log ORDER BY started_at DESC, run_id DESC LIMIT 1"))
def q_current_run(spark, sf_dir):
    _, log = _raw_person(spark, sf_dir)
    return store.current_run(log)


@register("snapshot_slice", O.with_ctes(RAW_LOG_SQL, """
SELECT * EXCLUDE (run_id) FROM raw_person
WHERE run_id = (SELECT run_id FROM run_log ORDER BY started_at DESC, run_id DESC LIMIT 1)"""))
def q_snapshot_slice(spark, sf_dir):
    raw, log = _raw_person(spark, sf_dir)
    return store.snapshot_slice(raw, store.resolve_current_run(log))


DIM_SQL_COLS = ", ".join(DIM_OUT)


def _dim_query(seqs, s):
    return O.with_ctes(O.state(list(seqs)), f"SELECT {DIM_SQL_COLS} FROM dim_{s}")


@register("scd2_first_load", _dim_query([1], 1))
def q_scd2_first_load(spark, sf_dir):
    return _warehouse(spark, sf_dir, (1,))[1][0].select(*DIM_OUT)


@register("scd2_merge", _dim_query([1, 2], 2))
def q_scd2_merge(spark, sf_dir):
    return _warehouse(spark, sf_dir, (1, 2))[2][0].select(*DIM_OUT)


@register("scd2_revive", _dim_query([1, 2, 3], 3))
def q_scd2_revive(spark, sf_dir):
    return _warehouse(spark, sf_dir, (1, 2, 3))[3][0].select(*DIM_OUT)


ENR_OUT = ["source_person_sk", "target_person_sk", "relationship_role_sk", "start_date_sk",
           "end_date_sk", "source_person_id", "target_person_id", "relationship_role_code",
           "start_date", "end_date", "end_reason"]


@register("enriched_edges", O.with_ctes(
    [*O.dims_only([1, 2]), O.dim_role(), O.dim_date(), O.keyed(1), O.keyed(2)], _union_sql(
        lambda s: f"SELECT 'r{s}' AS run_id, {', '.join(ENR_OUT)} FROM keyed_{s} WHERE hit")))
def q_enriched_edges(spark, sf_dir):
    # only the dimensions of both runs and their edges; no fact is merged
    role, date = materialize(dims.role_dimension(spark)), materialize(dims.seed_calendar(spark))
    dim, out = None, {}
    for s in (1, 2):
        person, family, relation = fixture.snapshot(spark, sf_dir, s)
        dim = materialize(scd2.scd2_merge(dim, person, O.run_name(s), _started(s), key="person_id",
                                          tracked=PERSON_TRACKED, sk_col="person_sk"))
        out[s] = kinship.enrich_edges(kinship.derive_edges(person, family, relation), dim, role, date)
    return _both(lambda s: out[s].select(*ENR_OUT))


@register("date_key_lookup", O.with_ctes([O.dim_date()], """
SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_shipdate AS DATE) AS ship_date,
       d.date_sk AS ship_date_sk, d.year_num, d.quarter_of_year, d.day_name, d.is_weekend
FROM lineitem l LEFT JOIN dim_date d ON d.full_date = CAST(l.l_shipdate AS DATE)"""))
def q_date_key_lookup(spark, sf_dir):
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("ship_date"))
    cal = F.broadcast(dims.seed_calendar(spark).select(
        F.col("full_date").alias("ship_date"), F.col("date_sk").alias("ship_date_sk"),
        "year_num", "quarter_of_year", "day_name", "is_weekend"))
    return line.join(cal, "ship_date", "left").select(
        "l_orderkey", "l_linenumber", "ship_date", "ship_date_sk", "year_num",
        "quarter_of_year", "day_name", "is_weekend")


FACT_SQL_COLS = ", ".join(O.FACT_OUT)


def _fact_query(seqs, s, where=""):
    return O.with_ctes(O.state(list(seqs)), f"SELECT {FACT_SQL_COLS} FROM fact_{s} {where}")


@register("fact_first_load", _fact_query([1], 1))
def q_fact_first_load(spark, sf_dir):
    return _warehouse(spark, sf_dir, (1,))[1][1].select(*O.FACT_OUT)


@register("fact_merge", _fact_query([1, 2], 2))
def q_fact_merge(spark, sf_dir):
    return _warehouse(spark, sf_dir, (1, 2))[2][1].select(*O.FACT_OUT)


@register("fact_soft_delete", _fact_query([1, 2], 2, "WHERE deleted_at_run_id = 'r2'"))
def q_fact_soft_delete(spark, sf_dir):
    f = _warehouse(spark, sf_dir, (1, 2))[2][1]
    return f.where(F.col("deleted_at_run_id") == "r2").select(*O.FACT_OUT)


@register("fact_revive", _fact_query([1, 2, 3], 3))
def q_fact_revive(spark, sf_dir):
    return _warehouse(spark, sf_dir, (1, 2, 3))[3][1].select(*O.FACT_OUT)


NAMES = "first_name || ' ' || last_name"


@register("history_all_versions", O.with_ctes([*O.state([1, 2, 3]), f"""version AS (
  SELECT person_sk, {{'name': {NAMES}, 'since': valid_from_run_id}} AS v FROM dim_3)"""], """
SELECT relationship_sk, source_person_id, a.v.name AS source_person, a.v.since AS source_version_from,
       target_person_id, b.v.name AS target_person, b.v.since AS target_version_from,
       source_relationship_role_code AS role, relationship_type, start_date, end_date, end_reason,
       first_seen_run_id, last_seen_run_id, is_deleted, deleted_at_run_id
FROM fact_3 NATURAL JOIN (SELECT relationship_role_sk, relationship_type FROM dim_role)
LEFT JOIN version a ON a.person_sk = source_person_sk LEFT JOIN version b ON b.person_sk = target_person_sk"""))
def q_history_all_versions(spark, sf_dir):
    dim, fct, _, role, _ = _warehouse(spark, sf_dir, (1, 2, 3))[3]
    return reports.fact_history(fct, dim, role)


@register("fact_history", O.with_ctes(O.state([1, 2, 3]), """
SELECT relationship_sk, source_person_id, target_person_id, source_relationship_role_code AS role, relationship_type,
       start_date, end_date, end_reason, first_seen_run_id, last_seen_run_id, is_deleted, deleted_at_run_id
FROM fact_3 NATURAL JOIN (SELECT relationship_role_sk, relationship_type FROM dim_role)"""))
def q_fact_history(spark, sf_dir):
    return q_history_all_versions(spark, sf_dir).drop("source_person", "source_version_from",
                                                      "target_person", "target_version_from")


def _run_log(spark, seqs):
    return spark.createDataFrame([(O.run_name(s), _started(s)) for s in seqs], RUN_LOG)


# who: the current persons, one struct each
WHO = f"""who AS (
  SELECT person_sk, {{'id': person_id, 'name': {NAMES}, 'born': birth_date, 'died': death_date,
                     'sort': [last_name, first_name]}} AS p FROM dim_2 WHERE valid_to_run_id IS NULL)"""
CARD_SQL = O.with_ctes([*O.state([1, 2]), WHO, """link AS (
  SELECT relationship_type AS kind, COLUMNS(fact_2.*) FROM dim_role JOIN fact_2 USING (relationship_role_sk)
  WHERE deleted_at_run_id IS NULL)"""], """
SELECT me.p.id AS person_id, me.p.name AS person, me.p.born AS person_birth_date, me.p.died AS person_death_date,
       kind AS relationship_type, source_relationship_role_code AS role, start_date AS relationship_start,
       end_date AS relationship_end, end_reason, you.p.id AS related_person_id, you.p.name AS related_person,
       you.p.born AS related_birth_date, you.p.died AS related_death_date
FROM link, who me, who you
WHERE (source_person_sk, target_person_sk) = (me.person_sk, you.person_sk)
ORDER BY me.p.sort[1] NULLS LAST, me.p.sort[2] NULLS LAST, kind, role, you.p.born NULLS LAST""")


@register("relationship_card", CARD_SQL)
def q_relationship_card(spark, sf_dir):
    dim, fct, _, role, _ = _warehouse(spark, sf_dir, (1, 2))[2]
    return reports.relationship_card(fct, dim, role)


# the outcome of a marriage by whether it was divorced and who has died
TIMELINE_SQL = O.with_ctes([*O.state([1, 2]), WHO, """outcome AS (
  SELECT * FROM (VALUES (FALSE, FALSE, 'Active'), (TRUE, FALSE, 'Husband deceased'),
                        (FALSE, TRUE, 'Wife deceased'), (TRUE, TRUE, 'Both deceased')) AS t(his, hers, outcome))""", """couple AS (
  SELECT f.*, he.p AS he, she.p AS she, year(start_date) AS marriage_year,
         list_min([he.p.died, she.p.died]) AS first_death
  FROM fact_2 f JOIN who he ON he.person_sk = source_person_sk JOIN who she ON she.person_sk = target_person_sk
  WHERE source_relationship_role_code = 'SPOUSE_HUSBAND' AND deleted_at_run_id IS NULL)"""], f"""
SELECT he.id AS husband_id, he.name AS husband, she.id AS wife_id, she.name AS wife,
       (SELECT d.year_num FROM dim_date d WHERE d.full_date = start_date) AS marriage_year,
       start_date AS marriage_date, end_date AS divorce_date, end_reason,
       if(coalesce(end_reason = 'DIVORCE', FALSE), 'Divorced', o.outcome) AS outcome,
       year(coalesce(end_date, first_death, DATE '{O.AS_OF_DATE}')) - couple.marriage_year AS years_together
FROM couple JOIN outcome o ON o.his = (he.died IS NOT NULL) AND o.hers = (she.died IS NOT NULL)
ORDER BY start_date NULLS LAST""")


@register("marriage_timeline", TIMELINE_SQL)
def q_marriage_timeline(spark, sf_dir):
    dim, fct, _, role, date = _warehouse(spark, sf_dir, (1, 2))[2]
    return reports.marriage_timeline(fct, dim, role, date, AS_OF)


# Paths of person ids first; names and dates are looked up afterwards.
CHAIN = [*O.state([1, 2]), """up AS (
  SELECT source_person_id AS child, list(target_person_id) AS parents FROM fact_2
  WHERE source_relationship_role_code = 'CHILD' AND NOT is_deleted GROUP BY child)""", """walk AS (
  SELECT [person_id] AS ids FROM dim_2 WHERE is_current
  UNION ALL
  SELECT list_append(ids, unnest(parents)) FROM walk JOIN up ON child = ids[-1])""", f"""known AS (
  SELECT person_id, {NAMES} AS name, birth_date, death_date FROM dim_2 WHERE is_current)""", """named AS (
  SELECT ids, string_agg(name, ' -> ' ORDER BY pos) AS lineage_path, count(*) = count(name) AS whole
  FROM (SELECT ids, unnest(ids) AS id, generate_subscripts(ids, 1) AS pos FROM walk) JOIN known ON person_id = id
  GROUP BY ids)""", """chain AS (
  SELECT r.person_id AS root_person_id, r.name AS root_person_name, r.birth_date AS root_birth_date,
         a.person_id AS ancestor_person_id, a.name AS ancestor_name, a.birth_date AS ancestor_birth_date,
         a.death_date AS ancestor_death_date, CAST(len(w.ids) - 1 AS INTEGER) AS generation_depth,
         if(whole, lineage_path, NULL) AS lineage_path
  FROM walk w JOIN named USING (ids) JOIN known r ON r.person_id = ids[1] JOIN known a ON a.person_id = ids[-1])"""]
CHAIN_COLS = ["root_person_id", "root_person_name", "root_birth_date", "ancestor_person_id",
              "ancestor_name", "ancestor_birth_date", "ancestor_death_date",
              "generation_depth", "lineage_path"]


@register("ancestor_closure", O.with_ctes(CHAIN, f"SELECT {', '.join(CHAIN_COLS)} FROM chain", recursive=True))
def q_ancestor_closure(spark, sf_dir):
    dim, fct, *_ = _warehouse(spark, sf_dir, (1, 2))[2]
    return reports.ancestor_closure(dim, fct).select(*CHAIN_COLS)


LINEAGE_SQL = O.with_ctes(CHAIN, """
SELECT root_person_name AS person, root_birth_date AS person_birth_date, generation_depth AS generations_back,
       coalesce(['Parent', 'Grandparent', 'Great-grandparent'][generation_depth],
                'Great-' || repeat('great-', generation_depth - 3) || 'grandparent') AS relation_label,
       ancestor_name AS ancestor, ancestor_birth_date, ancestor_death_date, lineage_path
FROM chain WHERE generation_depth > 0
ORDER BY root_birth_date DESC NULLS LAST, root_person_name NULLS LAST, generation_depth""", recursive=True)


@register("ancestor_lineage", LINEAGE_SQL)
def q_ancestor_lineage(spark, sf_dir):
    dim, fct, *_ = _warehouse(spark, sf_dir, (1, 2))[2]
    return reports.ancestor_lineage(dim, fct)


# --- the stored warehouse -------------------------------------------------------------


def _stored(spark, sf_dir, seqs=(1, 2, 3), **options) -> pipeline.Warehouse:
    """Incremental runs over the snapshots, read back from storage. The run ids of
    the queries are those of the SQL."""
    root = scratch_path(spark, "warehouse")
    for s in seqs:
        person, family, relation = fixture.snapshot(spark, sf_dir, _content(s))
        pipeline.run_increment(spark, root, person, family, relation, run_id=O.run_name(s), started_at=_started(s), **options)
    return pipeline.Warehouse(spark, root)


@register("stored_dim_person", _dim_query([1, 2, 3], 3))
def q_stored_dim_person(spark, sf_dir):
    return _stored(spark, sf_dir).table("dim_person").select(*DIM_OUT)


@register("stored_fact", _fact_query([1, 2, 3], 3))
def q_stored_fact(spark, sf_dir):
    return _stored(spark, sf_dir).table("fact_person_relationship").select(*O.FACT_OUT)


# Every run after the first as a delta on the base that the first one wrote.
ALL_DELTAS = {"compact_share": float("inf")}


# the state that the runs up to r2 leave, whatever r3 revives
@register("fact_as_of_run", O.with_ctes([*O.state([1, 2]), f"""person_then AS (
  SELECT person_id, works, {NAMES} AS name FROM dim_2 WHERE valid_to_run_id IS NULL)"""], """
SELECT source_person_id, a.name AS source_person, a.works AS source_works,
       target_person_id, b.name AS target_person, b.works AS target_works,
       source_relationship_role_code AS role, start_date, end_date, end_reason
FROM fact_2, person_then a, person_then b
WHERE deleted_at_run_id IS NULL AND a.person_id = source_person_id AND b.person_id = target_person_id"""))
def q_fact_as_of_run(spark, sf_dir):
    wh = _stored(spark, sf_dir, **ALL_DELTAS)
    return reports.fact_as_of_run(wh.edge_intervals(), wh.table("dim_person"), _run_log(spark, (1, 2, 3)), "r2")


# an edge's spans from the states that one, two and three runs leave: a span begins where an edge
# is live and was not before, and ends with the first run after that in which it is not
@register("edge_intervals", O.with_ctes(O.state([1, 2, 3]), """
SELECT relationship_sk, source_person_id, target_person_id, source_relationship_role_code, start_date, end_date, end_reason,
       from_run_id, to_run_id
FROM (
  SELECT relationship_sk, ['r1', 'r2', 'r3'][n] AS from_run_id, live,
         ['r1', 'r2', 'r3'][min(n) FILTER (WHERE NOT live) OVER (PARTITION BY relationship_sk ORDER BY n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)] AS to_run_id,
         coalesce(lag(live) OVER (PARTITION BY relationship_sk ORDER BY n), FALSE) AS before
  FROM (SELECT relationship_sk, 1 AS n, NOT is_deleted AS live FROM fact_1 UNION ALL SELECT relationship_sk, 2, NOT is_deleted FROM fact_2
        UNION ALL SELECT relationship_sk, 3, NOT is_deleted FROM fact_3))
JOIN fact_3 USING (relationship_sk) WHERE live AND NOT before"""))
def q_edge_intervals(spark, sf_dir):
    return _stored(spark, sf_dir, **ALL_DELTAS).edge_intervals()


@register("layered_dim_person", _dim_query([1, 2, 3], 3))
def q_layered_dim_person(spark, sf_dir):
    return _stored(spark, sf_dir, **ALL_DELTAS).table("dim_person").select(*DIM_OUT)


@register("layered_fact", _fact_query([1, 2, 3], 3))
def q_layered_fact(spark, sf_dir):
    return _stored(spark, sf_dir, **ALL_DELTAS).table("fact_person_relationship").select(*O.FACT_OUT)


def _report_tables(wh: pipeline.Warehouse):
    return (wh.table("fact_person_relationship"), wh.stored("dim_person_current"),
            wh.table("dim_relationship_role"), wh.table("dim_date"))


@register("stored_relationship_card", CARD_SQL)
def q_stored_relationship_card(spark, sf_dir):
    fct, current, role, _ = _report_tables(_stored(spark, sf_dir, (1, 2)))
    return reports.relationship_card(fct, current, role)


@register("stored_marriage_timeline", TIMELINE_SQL)
def q_stored_marriage_timeline(spark, sf_dir):
    return reports.marriage_timeline(*_report_tables(_stored(spark, sf_dir, (1, 2))), AS_OF)


@register("stored_ancestor_lineage", LINEAGE_SQL)
def q_stored_ancestor_lineage(spark, sf_dir):
    fct, current, *_ = _report_tables(_stored(spark, sf_dir, (1, 2)))
    return reports.ancestor_lineage(current, fct)


def _table_check_sql(table: str, key: str, source: str, violations: str = "FALSE", may_be_null: str = "") -> str:
    parts = [k for k in key.split(",") if k not in may_be_null.split(",")]
    return f"""SELECT '{table}' AS table_name, '{key}' AS key_columns, CAST(sum(n) AS BIGINT) AS n_rows,
       count(*) AS n_keys, count(*) FILTER (WHERE {' OR '.join(f'{k} IS NULL' for k in parts)}) AS n_null_keys,
       count(*) FILTER (WHERE n > 1) AS n_duplicate_keys, CAST(sum(v) AS BIGINT) AS n_not_null_violations
FROM (SELECT {key}, count(*) AS n, count(*) FILTER (WHERE {violations}) AS v FROM {source} GROUP BY {key})"""


@register("warehouse_key_check", O.with_ctes(O.state([1, 2, 3]), "\nUNION ALL\n".join([
    _table_check_sql("dim_person_current", "person_id", "(SELECT * FROM dim_3 WHERE is_current)"),
    _table_check_sql("dim_person_current", "person_sk", "(SELECT * FROM dim_3 WHERE is_current)"),
    _table_check_sql("fact_person_relationship", "relationship_sk", "fact_3"),
    _table_check_sql("fact_person_relationship",
                     "source_person_id,target_person_id,source_relationship_role_code,start_date,end_date,end_reason",
                     "fact_3", may_be_null="start_date,end_date,end_reason")])))
def q_warehouse_key_check(spark, sf_dir):
    wh = _stored(spark, sf_dir)
    return pipeline.table_checks(wh.stored("dim_person_current"), wh.table("fact_person_relationship"))


# --- changesets, profile, checks, the incremental run --------------------------------


CHANGE_SQL = [*FIX, """persons_g2 AS (
  SELECT * FROM person_1
  UNION ALL SELECT * FROM person_2 WHERE person_id NOT IN (SELECT person_id FROM person_1))""",
              """families_g2 AS (
  SELECT * FROM family_1
  UNION ALL SELECT * FROM family_2 WHERE family_id NOT IN (SELECT family_id FROM family_1))"""]


@register("changeset_insert", O.with_ctes(CHANGE_SQL, "SELECT * FROM persons_g2"))
def q_changeset_insert(spark, sf_dir):
    cust = fixture.read_customer(spark, sf_dir)
    return changeset.insert_nodes_if_absent(fixture.person_snapshot(cust, 1),
                                            fixture.person_snapshot(cust, 2), "person_id")


@register("changeset_edge_insert", O.with_ctes(CHANGE_SQL + ["""cand AS (
  SELECT DISTINCT person_id, family_id, relationship_type, role FROM relation_2
  WHERE person_id IN (SELECT person_id FROM persons_g2)
    AND family_id IN (SELECT family_id FROM families_g2))"""], """
SELECT * FROM relation_1
UNION ALL
SELECT * FROM cand c WHERE NOT EXISTS (
  SELECT 1 FROM relation_1 o
  WHERE o.person_id IS NOT DISTINCT FROM c.person_id AND o.family_id IS NOT DISTINCT FROM c.family_id
    AND o.relationship_type IS NOT DISTINCT FROM c.relationship_type
    AND o.role IS NOT DISTINCT FROM c.role)"""))
def q_changeset_edge_insert(spark, sf_dir):
    cust = fixture.read_customer(spark, sf_dir)
    p1, p2 = fixture.person_snapshot(cust, 1), fixture.person_snapshot(cust, 2)
    f1, f2 = fixture.family_snapshot(cust, 1), fixture.family_snapshot(cust, 2)
    persons = changeset.insert_nodes_if_absent(p1, p2, "person_id")
    families = changeset.insert_nodes_if_absent(f1, f2, "family_id")
    return changeset.insert_edges_if_absent(fixture.relation_snapshot(cust, 1, p1),
                                            fixture.relation_snapshot(cust, 2, p2),
                                            persons, families)


@register("changeset_update", O.with_ctes(FIX, """
SELECT a.person_id, a.first_name, a.last_name, a.sex, a.birth_date,
       CASE WHEN b.person_id IS NOT NULL THEN b.death_date ELSE a.death_date END AS death_date,
       a.education,
       CASE WHEN b.person_id IS NOT NULL THEN b.works ELSE a.works END AS works
FROM person_1 a LEFT JOIN person_2 b ON b.person_id = a.person_id"""))
def q_changeset_update(spark, sf_dir):
    cust = fixture.read_customer(spark, sf_dir)
    changes = fixture.person_snapshot(cust, 2).select("person_id", "death_date", "works")
    return changeset.update_properties(fixture.person_snapshot(cust, 1), changes, "person_id")


@register("changeset_edge_delete", O.with_ctes(FIX, """
SELECT * FROM relation_1 r WHERE EXISTS (
  SELECT 1 FROM relation_2 s WHERE s.person_id = r.person_id AND s.family_id = r.family_id
    AND s.relationship_type = r.relationship_type)"""))
def q_changeset_edge_delete(spark, sf_dir):
    cust = fixture.read_customer(spark, sf_dir)
    r1, r2 = fixture.relation_snapshot(cust, 1), fixture.relation_snapshot(cust, 2)
    keys = ["person_id", "family_id", "relationship_type"]
    return changeset.delete_edges(r1, r1.join(r2.select(*keys), keys, "left_anti"), keys)


def _elements(spark, sf_dir, seq=2):
    person, family, relation = fixture.snapshot(spark, sf_dir, seq)
    nodes = (profile.graph_elements(person, "Person", graph.PERSON_PROPS)
             .unionByName(profile.graph_elements(family, "Family", graph.FAMILY_PROPS)))
    edges = profile.graph_elements(relation, F.col("relationship_type"), {"role": "role"})
    return nodes, edges, relation


def _profile_sql() -> str:
    parts = []
    for label, table, props in [("Person", "person_2", graph.PERSON_PROPS),
                                ("Family", "family_2", graph.FAMILY_PROPS)]:
        for col, prop in props.items():
            typ = "Date" if col.endswith("_date") else "String"
            parts.append(f"SELECT '{label}' AS label, '{prop}' AS property_name, "
                         f"'{typ}' AS property_types, count({col}) AS present FROM {table}")
    parts.append("SELECT relationship_type, 'role', 'String', count(role) FROM relation_2 "
                 "GROUP BY relationship_type")
    props = "\n  UNION ALL ".join(parts)
    return O.with_ctes(FIX + [
        """el AS (
  SELECT 'Person' AS label, count(*) AS total FROM person_2
  UNION ALL SELECT 'Family', count(*) FROM family_2
  UNION ALL SELECT relationship_type, count(*) FROM relation_2 GROUP BY relationship_type)""",
        f"pp AS (\n  {props})"], """
SELECT el.label, p.property_name, p.property_types,
       coalesce(p.present = el.total, FALSE) AS mandatory
FROM el LEFT JOIN (SELECT * FROM pp WHERE present > 0) p ON p.label = el.label""")


@register("property_profile", _profile_sql())
def q_property_profile(spark, sf_dir):
    nodes, edges, _ = _elements(spark, sf_dir)
    prof = profile.property_profile(nodes.unionByName(edges))
    return prof.select("label", "property_name",
                       F.array_join("property_types", ",").alias("property_types"), "mandatory")


@register("label_catalog", O.with_ctes(FIX, """
SELECT 'node' AS kind, 'Person' AS name, count(*) AS n_elements,
       'id' AS unique_property FROM person_2
UNION ALL SELECT 'node', 'Family', count(*), 'id' FROM family_2
UNION ALL SELECT 'relationship', relationship_type, count(*), CAST(NULL AS VARCHAR) FROM relation_2
GROUP BY relationship_type"""))
def q_label_catalog(spark, sf_dir):
    nodes, _, relation = _elements(spark, sf_dir)
    return profile.label_catalog(nodes, relation)


def _key_sql(table: str, key: str, source: str) -> str:
    return f"""SELECT '{table}' AS table_name, 'run_id,{key}' AS key_columns,
       CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
       count(*) FILTER (WHERE run_id IS NULL OR {key} IS NULL) AS n_null_keys,
       count(*) FILTER (WHERE n > 1) AS n_duplicate_keys,
       CAST(sum(nn) AS BIGINT) AS n_not_null_violations
FROM (SELECT run_id, {key}, count(*) AS n, count(*) FILTER (WHERE {key} IS NULL) AS nn
      FROM ({source}) s GROUP BY run_id, {key}) g"""


@register("key_check", O.with_ctes(FIX, "\nUNION ALL\n".join([
    _key_sql("raw_person_snapshot", "person_id",
             "SELECT 'r1' AS run_id, * FROM person_1 UNION ALL SELECT 'r2', * FROM person_2"),
    _key_sql("raw_family_snapshot", "family_id",
             "SELECT 'r1' AS run_id, * FROM family_1 UNION ALL SELECT 'r2', * FROM family_2")])))
def q_key_check(spark, sf_dir):
    cust = fixture.read_customer(spark, sf_dir)
    persons = _both(lambda s: fixture.person_snapshot(cust, s))
    families = _both(lambda s: fixture.family_snapshot(cust, s))
    return (checks.key_summary(persons, "raw_person_snapshot", ["run_id", "person_id"], ["person_id"])
            .unionByName(checks.key_summary(families, "raw_family_snapshot",
                                            ["run_id", "family_id"], ["family_id"])))


@register("run_increment", O.with_ctes(O.state([1, 2]), """
SELECT 'dim_person' AS table_name, count(*) AS n_rows, count(*) FILTER (WHERE is_current) AS n_live,
       count(*) FILTER (WHERE is_deleted) AS n_deleted FROM dim_2
UNION ALL SELECT 'dim_relationship_role', count(*), count(*), 0 FROM dim_role
UNION ALL SELECT 'dim_date', count(*), count(*), 0 FROM dim_date
UNION ALL SELECT 'fact_person_relationship', count(*), count(*) FILTER (WHERE NOT is_deleted),
       count(*) FILTER (WHERE is_deleted) FROM fact_2
UNION ALL SELECT 'raw_person_snapshot', n, n, 0
  FROM (SELECT (SELECT count(*) FROM person_1) + (SELECT count(*) FROM person_2) AS n) x
UNION ALL SELECT 'raw_family_snapshot', n, n, 0
  FROM (SELECT (SELECT count(*) FROM family_1) + (SELECT count(*) FROM family_2) AS n) x
UNION ALL SELECT 'raw_relation_snapshot', n, n, 0
  FROM (SELECT (SELECT count(*) FROM relation_1) + (SELECT count(*) FROM relation_2) AS n) x
UNION ALL SELECT 'etl_run_log', 2, 2, 0"""))
def q_run_increment(spark, sf_dir):
    root = scratch_path(spark, "warehouse")
    for s in (1, 2):
        person, family, relation = fixture.snapshot(spark, sf_dir, s)
        pipeline.run_increment(spark, root, person, family, relation, run_id=O.run_name(s),
                               started_at=_started(s))
    return pipeline.table_summary(spark, root)
