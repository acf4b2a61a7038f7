"""Comparisons within groups, split into square cells.

A group of m rows is dealt into ceil(m / block) blocks by a hash of the id, and
every pair of blocks is a cell of its own, so that a task never holds more than
about two blocks of a group, however large the group is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cells_of(df: DataFrame, group: str, member: str, size: str, block: int) -> DataFrame:
    """One row per member and cell: adds cell_i <= cell_j and side (the member's own block)."""
    n: Column = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64(member), n).cast("int")
    return (df.withColumn("cell_n", n).withColumn("side", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cell_n") - 1)))
            .withColumn("cell_i", F.least("side", "other")).withColumn("cell_j", F.greatest("side", "other"))
            .withColumn("cell", F.col(group)).drop("cell_n", "other", size, group))


def groups_in(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, from batches sorted by them."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        rest = None
        if not len(table):
            continue
        changed = np.zeros(len(table), dtype=bool)
        for key in keys:
            values = table.column(key).to_numpy()
            changed[1:] |= values[1:] != values[:-1]
        cut = np.flatnonzero(changed)
        edges = [0, *cut.tolist()]
        for a, b in zip(edges, edges[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(edges[-1])
    if rest is not None and len(rest):
        yield rest


def grouped(cells: DataFrame, compare: Callable) -> DataFrame:
    """Links (src, dst) that ``compare(rows of a cell, its two sides)`` yields."""
    keys = ["cell", "cell_i", "cell_j"]

    def run(batches):
        src, dst = [], []

        def out():
            return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])

        for table in groups_in(batches, keys):
            if len(table) < 2:
                continue
            side = table.column("side").to_numpy()
            i, j = table.column("cell_i")[0].as_py(), table.column("cell_j")[0].as_py()
            for a, b in compare(table.combine_chunks(), np.stack([side == i, side == j])):
                src.append(int(a))
                dst.append(int(b))
            if len(src) >= 10_000:
                yield out()
                src, dst = [], []
        yield out()

    return cells.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "src long, dst long")
