"""Digests of a keyed table by key bucket, to find what differs without a join (M2, M7).

A *leaf* is a bucket of a hash of the key; its digest is the number of its rows and two
sums of independent 64-bit hashes of key and contents (equal rows give equal digests;
leaves that differ agree by a chance of about 2^-90). Leaves add up to nodes of the level
above. Two tables are compared from the top: nodes with equal digests are left alone, and
of the others the leaves that differ are found. The tables of digests are as large as the
number of leaves, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Leaves of a table, and leaves of a node of the level above.
LEAVES, FAN = 4096, 64
_SUMS = ["n", "sum_a", "sum_b"]


def leaf_of(key: Sequence[str], leaves: int = LEAVES) -> Column:
    """The leaf of a row. With leaves a multiple of n, leaf modulo n is the row's bucket in a
    table that Spark buckets by the same columns into n."""
    return F.pmod(F.hash(*key), F.lit(leaves)).cast("int")


def leaf_digests(df: DataFrame, key: Sequence[str], contents: Sequence[str], leaves: int = LEAVES,
                 leaf: Column | None = None) -> DataFrame:
    """(leaf, n, sum_a, sum_b): one pass, added up before the shuffle. NULLs differ from all values.
    ``leaf``, a function of the key, takes the place of the hash."""
    leaf = leaf_of(key, leaves) if leaf is None else leaf
    marks = [F.col(c).isNull() for c in contents]
    whole = F.xxhash64(*key, *contents, *marks)
    return df.groupBy(leaf.alias("leaf")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(whole.cast("decimal(38,0)")).alias("sum_a"),
        F.sum(F.xxhash64(F.lit(1), whole, F.hash(*contents, *key, *marks)).cast("decimal(38,0)")).alias("sum_b"))


def node_digests(leaves: DataFrame, fan: int = FAN) -> DataFrame:
    """The level above: digests add up."""
    return leaves.groupBy(F.floor(F.col("leaf") / fan).cast("int").alias("leaf")).agg(
        *[F.sum(c).alias(c) for c in _SUMS])


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    other = b.select(F.col("leaf").alias("_leaf"), *[F.col(c).alias(f"_{c}") for c in _SUMS])
    same = (F.col("leaf") == F.col("_leaf"))
    unlike = F.lit(False)
    for c in _SUMS:
        unlike = unlike | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    return a.join(other, same, "full_outer").where(unlike).select(F.coalesce("leaf", "_leaf").alias("leaf"))


def differing_leaves(a: DataFrame, b: DataFrame, fan: int = FAN) -> list[int]:
    """The leaves whose digests differ (at most as many as there are leaves), found from the nodes down."""
    nodes = [r["leaf"] for r in _differing(node_digests(a, fan), node_digests(b, fan)).collect()]
    if not nodes:
        return []
    below = F.floor(F.col("leaf") / fan).cast("int").isin(nodes)
    return sorted(r["leaf"] for r in _differing(a.where(below), b.where(below)).collect())
