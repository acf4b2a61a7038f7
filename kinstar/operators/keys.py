"""Distributed surrogate keys (K1).

Keys are dense and increasing in the order of a natural key, starting after
``start``: the same numbers a global ``row_number() OVER (ORDER BY key)``
would give, but computed without funnelling the data through one task:

1. range-partition on the natural key and sort inside each partition;
2. write the rows with their partition number and position to a table in the
   shared checkpoint folder, so that both passes below see the same numbers
   even if an executor is lost;
3. count rows per partition (one row per partition, a bounded table) and
   turn the counts into exclusive prefix offsets;
4. key = start + offset[partition] + position within the partition + 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinstar.session import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id: partition index << 33 | row


def _order_cols(order_by: Sequence[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]


def with_surrogate_key(df: DataFrame, order_by: Sequence[str | Column], sk_col: str,
                       start: int = 0, num_partitions: int | None = None,
                       stats: dict | None = None) -> DataFrame:
    """Append ``sk_col`` = start + 1, start + 2, ... in ``order_by`` order.

    ``order_by`` columns are ascending with NULLs first unless given as
    Columns. Ties get distinct keys in an unspecified order. With ``stats``
    the new high-water mark (start + number of rows) is stored under
    ``stats["high_water"]``, read off the per-partition counts.
    """
    order = _order_cols(order_by)
    # Without an explicit count AQE sizes the range partitions from the
    # actual data (a 7-row seed becomes one partition, a billion-row load
    # gets as many as its bytes need).
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    # Both columns are computed by the task that sorts the range partition.
    pos = materialize(ranged.sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")), "keys")
    counts = pos.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # One row per partition: a bounded table, so a single-partition window
    # and a broadcast are safe at any data size.
    offsets = counts.select(
        "_pid",
        (F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    if stats is not None:
        stats["high_water"] = start + int(counts.agg(F.sum("_cnt")).first()[0] or 0)
    keyed = pos.join(F.broadcast(offsets), "_pid", "left")
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), _LOCAL_BITS)
    sk = F.lit(start).cast("long") + F.coalesce(F.col("_off"), F.lit(0)).cast("long") + local + 1
    return keyed.select(*df.columns, sk.alias(sk_col))


def next_key_base(existing: DataFrame, sk_col: str) -> int:
    """max(sk) of a table, 0 when empty (one scalar to the driver)."""
    v = existing.agg(F.max(sk_col)).first()[0]
    return int(v) if v is not None else 0
