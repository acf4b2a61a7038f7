"""Merge-on-read tables: a base and the changes since (M2-M5).

A run that changes few rows of a large table writes these rows only. A table is a *base*
version and, since then, one *delta* per run with the rows that the run inserted or
replaced. A row is replaced by the newest delta row of its key, and a delta row may say
that the row is gone. Deltas are small, so they are reduced to one row per key first; the
base, bucketed by its key, is anti-joined with them and never shuffled.

The facts of a run that touch nearly every live row (``last_seen_run_id`` and
``updated_at`` move with each run) are not stored in the rows: a NULL there means *open*,
touched by every run since the row was written, and reads as the newest run. Only when a
run stops touching a row, it writes the row with the run that did so last.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinstar.operators.fact import EDGE_HASH, FACT_COLUMNS, KEY_IN_FACT, REFRESHED, edge_hash
from kinstar.operators.keys import with_surrogate_key
from kinstar.schemas import EDGE_KEY, EDGE_NULLABLE_KEY

#: The run since which a fact row is live without a break.
LIVE_SINCE = "live_since_run_id"
STORED_FACT = [*FACT_COLUMNS, EDGE_HASH, LIVE_SINCE]
INTERVAL = ["relationship_sk", *[KEY_IN_FACT[k] for k in EDGE_KEY], "from_run_id", "to_run_id"]


def newest(deltas: Sequence[DataFrame], key: Sequence[str]) -> DataFrame | None:
    """One row per key: that of the last of ``deltas`` that has it."""
    if not deltas:
        return None
    if len(deltas) == 1:
        return deltas[0]
    cols = deltas[0].columns
    rows = [d.select(F.lit(i).alias("_seq"), *cols) for i, d in enumerate(deltas)]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    kept = out.groupBy(*key).agg(F.max_by(F.struct(*cols), "_seq").alias("_row"))
    return kept.select(*[F.col(f"_row.{c}").alias(c) for c in cols])


def not_replaced(base: DataFrame, delta: DataFrame | None, place: str, same: str | None = None) -> DataFrame:
    """The rows of the base that no delta row replaces. ``place`` is the bucket column; of rows
    that share it, ``same`` (a long) tells which is meant."""
    if delta is None:
        return base
    d = delta.select(F.col(place).alias("_d_place"), *([F.col(same).alias("_d_same")] if same else []))
    cond = F.col(place) == F.col("_d_place")
    if same:
        # not an equality, lest Spark joins by both columns and shuffles the base for it
        cond = cond & (F.abs(F.col(same) - F.col("_d_same")) < 1)
    return base.join(d, cond, "left_anti")


def edge_condition() -> Column:
    """Fact row = edge (columns ``_e_...``), leading with the hash that buckets the fact."""
    cond = F.col(EDGE_HASH) == F.col(f"_e_{EDGE_HASH}")
    for k in EDGE_KEY:
        a, b = F.col(KEY_IN_FACT[k]), F.col(f"_e_{k}")
        cond = cond & (a.eqNullSafe(b) if k in EDGE_NULLABLE_KEY else a == b)
    return cond


def renamed_edges(flagged: DataFrame) -> DataFrame:
    """The run's edges with the names that :func:`edge_condition` uses."""
    e = flagged.select(*[F.col(c).alias(f"_e_{c}") for c in flagged.columns], F.lit(True).alias("_e_in"))
    return e.withColumn(f"_e_{EDGE_HASH}", edge_hash("_e_", fact_names=False))


def fact_changes(rows: Sequence[DataFrame], edges: DataFrame, run_id: str, as_of: dt.datetime,
                 last_run: str | None, last_as_of: dt.datetime | None) -> DataFrame:
    """The rows of the stored fact that the run has to write anew; ``rows`` are the parts of its
    state (each joined on its own, so that a bucketed part keeps its place).

    =====================  =======================  ==================================
    stored row             edge                     written
    =====================  =======================  ==================================
    open, same keys        present, enriched        nothing
    other                  present, enriched        open, keys refreshed, not deleted
    open                   present, not enriched    last seen in the last run
    live                   absent                   deleted by this run
    other                  other                    nothing
    =====================  =======================  ==================================
    """
    run, now = F.lit(run_id), F.lit(as_of).cast("timestamp_ntz")
    in_edge = F.col("_e_in").isNotNull()
    touched = in_edge & F.coalesce(F.col("_e__enriched"), F.lit(False))
    is_open = F.col("last_seen_run_id").isNull()
    same = F.lit(True)
    for c in REFRESHED:
        same = same & F.col(c).eqNullSafe(F.col(f"_e_{c}"))
    renew = touched & ~(is_open & same)
    deleted = ~in_edge & ~F.col("is_deleted")
    missed = in_edge & ~touched & is_open
    seen = F.coalesce("last_seen_run_id", F.lit(last_run).cast("string"))
    none = F.lit(None)

    def pick(c: str) -> Column:
        if c in REFRESHED:
            return F.when(renew, F.col(f"_e_{c}")).otherwise(F.col(c))
        return {
            "last_seen_run_id": F.when(renew, none.cast("string")).otherwise(seen),
            "updated_at": F.when(renew, none.cast("timestamp_ntz")).when(deleted, now).otherwise(
                F.coalesce("updated_at", F.lit(last_as_of).cast("timestamp_ntz"))),
            "is_deleted": F.when(renew, F.lit(False)).when(deleted, F.lit(True)).otherwise(F.col(c)),
            "deleted_at_run_id": F.when(renew, none.cast("string")).when(deleted, run).otherwise(F.col("deleted_at_run_id")),
            LIVE_SINCE: F.when(renew & F.col("is_deleted"), run).otherwise(F.col(LIVE_SINCE)),
        }.get(c, F.col(c))

    out = None
    for part in rows:
        changed = part.join(edges, edge_condition(), "left").where(renew | deleted | missed).select(
            *[pick(c).alias(c) for c in STORED_FACT])
        out = changed if out is None else out.unionByName(changed)
    return out


def fact_inserts(edges: DataFrame, known: Sequence[DataFrame], run_id: str, as_of: dt.datetime, key_base: int,
                 stats: dict) -> DataFrame:
    """New fact rows, open: enriched edges that none of ``known`` has, with keys after ``key_base``."""
    fresh = edges.where("_e__enriched")
    for part in known:
        fresh = fresh.join(part, edge_condition(), "left_anti")
    run, null = F.lit(run_id), F.lit(None).cast("string")
    rows = fresh.select(
        *[F.col(f"_e_{c}").alias(c) for c in REFRESHED], *[F.col(f"_e_{k}").alias(KEY_IN_FACT[k]) for k in EDGE_KEY],
        run.alias("first_seen_run_id"), null.alias("last_seen_run_id"), F.lit(False).alias("is_deleted"),
        null.alias("deleted_at_run_id"), F.lit(1).alias("relation_count"), F.lit(as_of).cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"), F.col(f"_e_{EDGE_HASH}").alias(EDGE_HASH), run.alias(LIVE_SINCE))
    order = [F.col(KEY_IN_FACT[k]).asc_nulls_first() for k in EDGE_KEY]
    return with_surrogate_key(rows, order, "relationship_sk", start=key_base, stats=stats).select(*STORED_FACT)


def as_read(fact: DataFrame, last_run: str, last_as_of: dt.datetime | None) -> DataFrame:
    """Open rows as touched by the newest run."""
    return fact.withColumns({
        "last_seen_run_id": F.coalesce("last_seen_run_id", F.lit(last_run)),
        "updated_at": F.coalesce("updated_at", F.lit(last_as_of).cast("timestamp_ntz"), F.col("created_at"))})


def ended_intervals(changes: DataFrame, run_id: str) -> DataFrame:
    """The spans of runs in which the rows that a run deletes had been live: from the run that
    brought the edge (back) up to, without it, the run that deletes it."""
    return changes.where(F.col("is_deleted") & (F.col("deleted_at_run_id") == run_id)).select(
        *INTERVAL[:-2], F.col(LIVE_SINCE).alias("from_run_id"), F.lit(run_id).alias("to_run_id"))


def open_intervals(fact: DataFrame) -> DataFrame:
    """The spans of the live rows, which have no end yet."""
    return fact.where(~F.col("is_deleted")).select(
        *INTERVAL[:-2], F.col(LIVE_SINCE).alias("from_run_id"), F.lit(None).cast("string").alias("to_run_id"))
