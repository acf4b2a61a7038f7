"""Slowly changing (type 2) dimension merge (M2).

A current version whose key and hash are in the snapshot is the *same*; all
else follows from that by semi- and anti-joins of the current versions with
the snapshot's (key, hash):

* current, same           -> kept as is
* current, key in the snapshot with another hash
                          -> expired (is_current = FALSE, valid_to = run)
* current, key not in the snapshot
                          -> deleted (is_current = FALSE, is_deleted = TRUE,
                             valid_to = run)
* snapshot, not the same  -> new version inserted (a new or changed key, or
                             one that returns after a deletion)

The current versions, stored bucketed by the key, are never shuffled or
copied; only snapshot rows move, and only the inserted ones are numbered.

Expired history rows never change and are passed through untouched. New
versions get surrogate keys after the current maximum, in business-key
order (K1).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinstar.functions.columns import attr_hash
from kinstar.operators.keys import next_key_base, with_surrogate_key


def dim_columns(key: str, tracked: Sequence[str], sk_col: str) -> list[str]:
    return [sk_col, key, *tracked, "attr_hash", "valid_from_run_id", "valid_to_run_id",
            "is_current", "is_deleted", "created_at"]


def empty_dimension(snapshot: DataFrame, key: str, tracked: Sequence[str], sk_col: str) -> DataFrame:
    """A zero-row dimension with the column types of ``snapshot``."""
    return snapshot.where(F.lit(False)).select(
        F.lit(None).cast("long").alias(sk_col), key, *tracked,
        F.lit(None).cast("string").alias("attr_hash"),
        F.lit(None).cast("string").alias("valid_from_run_id"),
        F.lit(None).cast("string").alias("valid_to_run_id"),
        F.lit(None).cast("boolean").alias("is_current"),
        F.lit(None).cast("boolean").alias("is_deleted"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"))


def scd2_parts(current: DataFrame, snapshot: DataFrame, run_id: str, as_of: dt.datetime,
               key: str, tracked: Sequence[str], sk_col: str, key_base: int,
               stats: dict | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(kept, inserted, closed)``: the current versions that stay, the versions that the
    snapshot adds (with keys after ``key_base``), and the versions that the run closes
    (expired or deleted). Both sides may be restricted to the same set of keys; then so
    is the result. ``stats["high_water"]`` receives the largest key in use afterwards.
    """
    cols = dim_columns(key, tracked, sk_col)
    run = F.lit(run_id)
    snap = snapshot.select(key, *tracked, attr_hash(*tracked).alias("_s_hash"))
    seen = snap.select(F.col(key).alias("_s_key"), "_s_hash")
    same = (F.col(key) == F.col("_s_key")) & F.col("attr_hash").eqNullSafe(F.col("_s_hash"))

    kept = current.join(seen, same, "left_semi").select(*cols)
    left = current.join(seen, F.col(key) == F.col("_s_key"), "left").where(
        F.col("_s_key").isNull() | ~F.col("attr_hash").eqNullSafe(F.col("_s_hash")))
    closed = left.select(
        sk_col, key, *tracked, "attr_hash", "valid_from_run_id",
        run.alias("valid_to_run_id"), F.lit(False).alias("is_current"),
        (F.col("is_deleted") | F.col("_s_key").isNull()).alias("is_deleted"), "created_at")
    had = current.select(F.col(key).alias("_c_key"), F.col("attr_hash").alias("_c_hash"))
    fresh = snap.join(had, (F.col(key) == F.col("_c_key"))
                      & F.col("_s_hash").eqNullSafe(F.col("_c_hash")), "left_anti")
    inserts = fresh.select(
        key, *tracked, F.col("_s_hash").alias("attr_hash"), run.alias("valid_from_run_id"),
        F.lit(None).cast("string").alias("valid_to_run_id"),
        F.lit(True).alias("is_current"), F.lit(False).alias("is_deleted"),
        F.lit(as_of).cast("timestamp_ntz").alias("created_at"))
    keyed = with_surrogate_key(inserts, [key], sk_col, start=key_base, stats=stats).select(*cols)
    return kept, keyed, closed.select(*cols)


def scd2_apply(current: DataFrame, snapshot: DataFrame, run_id: str, as_of: dt.datetime,
               key: str, tracked: Sequence[str], sk_col: str,
               key_base: int) -> tuple[DataFrame, DataFrame]:
    """Apply a snapshot to the *current* versions only.

    Returns ``(next_current, closed)``: the current versions after the run
    (unchanged rows plus inserted versions with keys after ``key_base``) and
    the rows this run closed. History rows are not needed at all, so a store
    can keep them append-only.
    """
    kept, keyed, closed = scd2_parts(current, snapshot, run_id, as_of, key, tracked, sk_col, key_base)
    return kept.unionByName(keyed), closed


def scd2_merge(dim: DataFrame | None, snapshot: DataFrame, run_id: str, as_of: dt.datetime,
               key: str, tracked: Sequence[str], sk_col: str) -> DataFrame:
    """The next version of the whole dimension after applying ``snapshot``."""
    cols = dim_columns(key, tracked, sk_col)
    if dim is None:
        dim = empty_dimension(snapshot, key, tracked, sk_col)
    history = dim.where(~F.col("is_current"))
    current = dim.where(F.col("is_current"))
    nxt, closed = scd2_apply(current, snapshot, run_id, as_of, key, tracked, sk_col,
                             key_base=next_key_base(dim, sk_col))
    return history.select(*cols).unionByName(closed).unionByName(nxt)
