"""Factless fact upsert with soft delete and revival (M3-M5).

The fact's natural key is the 6-column edge key (source, target, role code,
start, end, reason); the last three compare null-safely. Given the distinct
edges of the current snapshot, each flagged with whether the dimension
lookups succeeded (``_enriched``), the existing rows come from ``fact LEFT JOIN
edges`` and the inserted ones from ``enriched edges LEFT ANTI JOIN fact``, both
on the null-safe key:

======================  ===========================  =========================
fact row                edge                          result
======================  ===========================  =========================
present                 present, enriched             touched: keys refreshed,
                                                      last_seen = run, revived
                                                      if soft-deleted
present                 present, not enriched         unchanged
present, live           absent                        soft-deleted at run
present, deleted        absent                        unchanged
absent                  present, enriched             inserted with a new key
absent                  present, not enriched         nothing
======================  ===========================  =========================

The run's edges are written once, as a table of the run, because both joins
read them. The stored fact, bucketed by a hash of the key, is neither shuffled
nor copied; only the inserted rows are numbered.

So an edge whose endpoint has no current dimension row is neither inserted
nor soft-deleted, and a revived row keeps its first_seen run.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinstar.operators.keys import next_key_base, with_surrogate_key
from kinstar.schemas import EDGE_KEY, EDGE_NULLABLE_KEY, FACT
from kinstar.session import materialize

FACT_COLUMNS = [f.name for f in FACT.fields]
# Fact column holding each part of the edge key.
KEY_IN_FACT = {k: ("source_relationship_role_code" if k == "relationship_role_code" else k)
               for k in EDGE_KEY}
REFRESHED = ["source_person_sk", "target_person_sk", "relationship_role_sk",
             "start_date_sk", "end_date_sk"]


EDGE_HASH = "edge_key"


def edge_hash(prefix: str = "", fact_names: bool = True) -> F.Column:
    """64-bit hash of the 6-column edge key: the bucket column of a stored
    fact. Equal keys hash equally (NULLs included); a collision only costs
    a failed residual comparison, never a wrong match."""
    cols = [f"{prefix}{KEY_IN_FACT[k] if fact_names else k}" for k in EDGE_KEY]
    return F.xxhash64(*cols)


def empty_fact(spark) -> DataFrame:
    return spark.createDataFrame([], FACT)


def merge_fact(fact: DataFrame | None, flagged_edges: DataFrame, run_id: str,
               as_of: dt.datetime, hashed_key: bool = False,
               align_partitions: int | None = None, key_base: int | None = None,
               stats: dict | None = None) -> DataFrame:
    """Next version of the fact; ``flagged_edges`` = ``enrich_edges(...,
    keep_unmatched=True)`` over the distinct edges of the current run.

    With ``hashed_key`` the fact carries ``edge_key`` (see ``edge_hash``) and
    the join leads with it, so a fact stored bucketed by ``edge_key`` is
    joined without being shuffled; the output keeps the column, and
    ``align_partitions`` hash-partitions the inserted rows by it so every
    output partition holds one bucket. ``key_base`` is the largest key in use
    (default: scanned from ``fact``); ``stats["high_water"]`` receives the
    largest key in use afterwards.
    """
    if fact is None:
        fact = empty_fact(flagged_edges.sparkSession)
        if hashed_key:
            fact = fact.withColumn(EDGE_HASH, F.lit(None).cast("long"))
    run, now = F.lit(run_id), F.lit(as_of).cast("timestamp_ntz")
    e = flagged_edges.select(*[F.col(c).alias(f"_e_{c}") for c in flagged_edges.columns],
                             F.lit(True).alias("_e_in"))
    cond = None
    if hashed_key:
        e = e.withColumn(f"_e_{EDGE_HASH}", edge_hash("_e_", fact_names=False))
        cond = F.col(EDGE_HASH) == F.col(f"_e_{EDGE_HASH}")
    for k in EDGE_KEY:
        fc, ec = F.col(KEY_IN_FACT[k]), F.col(f"_e_{k}")
        term = fc.eqNullSafe(ec) if k in EDGE_NULLABLE_KEY else fc == ec
        cond = term if cond is None else cond & term
    e = materialize(e, "edges")
    j = fact.join(e, cond, "left")

    in_edge = F.col("_e_in").isNotNull()
    enriched = F.coalesce(F.col("_e__enriched"), F.lit(False))
    touched = in_edge & enriched
    soft_deleted = ~in_edge & ~F.col("is_deleted")

    def pick(c: str) -> F.Column:
        if c in REFRESHED:
            return F.when(touched, F.col(f"_e_{c}")).otherwise(F.col(c))
        if c == "last_seen_run_id":
            return F.when(touched, run).otherwise(F.col(c))
        if c == "is_deleted":
            return (F.when(touched, F.lit(False)).when(soft_deleted, F.lit(True))
                    .otherwise(F.col(c)))
        if c == "deleted_at_run_id":
            return (F.when(touched, F.lit(None).cast("string")).when(soft_deleted, run)
                    .otherwise(F.col(c)))
        if c == "updated_at":
            return F.when(touched | soft_deleted, now).otherwise(F.col(c))
        return F.col(c)

    out_cols = FACT_COLUMNS + ([EDGE_HASH] if hashed_key else [])
    existing = j.select(*[pick(c).alias(c) for c in out_cols])

    inserts = e.where("_e__enriched").join(fact, cond, "left_anti").select(
        *[F.col(f"_e_{c}").alias(c) for c in REFRESHED],
        *[F.col(f"_e_{k}").alias(KEY_IN_FACT[k]) for k in EDGE_KEY],
        run.alias("first_seen_run_id"), run.alias("last_seen_run_id"),
        F.lit(False).alias("is_deleted"), F.lit(None).cast("string").alias("deleted_at_run_id"),
        F.lit(1).alias("relation_count"), now.alias("created_at"), now.alias("updated_at"),
        *([F.col(f"_e_{EDGE_HASH}").alias(EDGE_HASH)] if hashed_key else []))
    order = [F.col(KEY_IN_FACT[k]).asc_nulls_first() for k in EDGE_KEY]
    base = next_key_base(fact, "relationship_sk") if key_base is None else key_base
    keyed = with_surrogate_key(inserts, order, "relationship_sk", start=base,
                               stats=stats).select(*out_cols)
    if align_partitions:
        keyed = keyed.repartition(align_partitions, EDGE_HASH if hashed_key else KEY_IN_FACT[EDGE_KEY[0]])
    return existing.unionByName(keyed)
