"""Key and not-null checks.

Parquet enforces no PRIMARY KEY / UNIQUE / NOT NULL, so the constraints are
checked as aggregates: one partial-aggregated pass per key, whose result
holds only the violations (or one summary row per check).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ConstraintViolation(ValueError):
    pass


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def key_summary(df: DataFrame, table: str, key: Sequence[str],
                not_null: Sequence[str] = (), nullable: Sequence[str] = ()) -> DataFrame:
    """One row: table, key, rows, distinct keys, NULL keys, duplicated keys,
    NULLs in NOT NULL columns. Two aggregation levels, no join. ``nullable``
    parts of the key may be NULL, and NULLs count as equal."""
    key = list(key)
    violation = F.lit(False)
    for c in not_null:
        violation = violation | F.col(c).isNull()
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"),
                                   F.count_if(violation).alias("_nn"))
    null_key = F.lit(False)
    for k in [k for k in key if k not in nullable]:
        null_key = null_key | F.col(k).isNull()
    return per_key.agg(
        F.lit(table).alias("table_name"), F.lit(",".join(key)).alias("key_columns"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_rows"),
        F.count(F.lit(1)).cast("long").alias("n_keys"),
        F.count_if(null_key).cast("long").alias("n_null_keys"),
        F.count_if(F.col("_n") > 1).cast("long").alias("n_duplicate_keys"),
        F.coalesce(F.sum("_nn"), F.lit(0)).cast("long").alias("n_not_null_violations"))


def null_summary(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """A row like ``key_summary``'s for NOT NULL columns that are no key: one pass."""
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    return df.agg(F.lit(table).alias("table_name"), F.lit(",".join(columns)).alias("key_columns"),
                  F.count(F.lit(1)).alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
                  F.lit(0).cast("long").alias("n_null_keys"), F.lit(0).cast("long").alias("n_duplicate_keys"),
                  F.count_if(missing).cast("long").alias("n_not_null_violations"))


def range_summary(df: DataFrame, table: str, column: str, above: int, up_to: int) -> DataFrame:
    """A row like ``key_summary``'s: values outside (above, up_to] count as null keys."""
    outside = F.col(column).isNull() | (F.col(column) <= above) | (F.col(column) > up_to)
    return df.agg(F.lit(table).alias("table_name"), F.lit(f"{column} in ({above}, {up_to}]").alias("key_columns"),
                  F.count(F.lit(1)).alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
                  F.count_if(outside).cast("long").alias("n_null_keys"), F.lit(0).cast("long").alias("n_duplicate_keys"),
                  F.lit(0).cast("long").alias("n_not_null_violations"))


def none_summary(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """A row like ``key_summary``'s over rows that must not be: each counts as a duplicated key."""
    return df.agg(F.lit(table).alias("table_name"), F.lit(",".join(key)).alias("key_columns"),
                  F.count(F.lit(1)).alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
                  F.lit(0).cast("long").alias("n_null_keys"), F.count(F.lit(1)).cast("long").alias("n_duplicate_keys"),
                  F.lit(0).cast("long").alias("n_not_null_violations"))


def union(summaries: Sequence[DataFrame]) -> DataFrame:
    out = summaries[0]
    for s in summaries[1:]:
        out = out.unionByName(s)
    return out


def assert_valid(summary: DataFrame) -> None:
    """Fail the run when any check in a ``key_summary`` union has violations."""
    bad = summary.where((F.col("n_null_keys") > 0) | (F.col("n_duplicate_keys") > 0)
                        | (F.col("n_not_null_violations") > 0)).collect()
    if bad:
        raise ConstraintViolation("; ".join(
            f"{r['table_name']}({r['key_columns']}): {r['n_duplicate_keys']} duplicated, "
            f"{r['n_null_keys']} null keys, {r['n_not_null_violations']} null values"
            for r in bad))
