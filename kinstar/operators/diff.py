"""Hash-based snapshot diff (M1, M7).

Generic over key and tracked columns: used for persons (the SCD-2 input)
and for any keyed table (``orders`` in the volume check).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinstar.functions.columns import attr_hash
from kinstar.operators import digest
from kinstar.session import materialize

NEW, CHANGED, DELETED, SAME = "new", "changed", "deleted", "same"


def with_attr_hash(df: DataFrame, tracked: Sequence[str], hash_col: str = "attr_hash") -> DataFrame:
    """M1: append md5 of the '|'-joined tracked values (NULL read as '')."""
    return df.withColumn(hash_col, attr_hash(*tracked))


def snapshot_diff(prev: DataFrame, cur: DataFrame, key: Sequence[str], tracked: Sequence[str],
                  carry: Sequence[str] = ()) -> DataFrame:
    """M7: classify every key of either snapshot as new / changed / deleted /
    same, by one full outer join of (key, hash) projections.

    ``carry`` columns are returned from both sides as ``prev_<c>`` and
    ``cur_<c>``.
    """
    key = list(key)
    p = prev.select(*key, attr_hash(*tracked).alias("_h"), F.lit(True).alias("_in_prev"),
                    *[F.col(c).alias(f"prev_{c}") for c in carry])
    c = cur.select(*key, attr_hash(*tracked).alias("_h2"), F.lit(True).alias("_in_cur"),
                   *[F.col(x).alias(f"cur_{x}") for x in carry])
    j = p.join(c, key, "full_outer")
    change = (F.when(F.col("_in_prev").isNull(), F.lit(NEW))
              .when(F.col("_in_cur").isNull(), F.lit(DELETED))
              .when(~F.col("_h").eqNullSafe(F.col("_h2")), F.lit(CHANGED))
              .otherwise(F.lit(SAME)))
    return j.select(*key, change.alias("change_type"),
                    *[f"prev_{x}" for x in carry], *[f"cur_{x}" for x in carry])


def snapshot_diff_by_leaves(prev: DataFrame, cur: DataFrame, key: Sequence[str], tracked: Sequence[str],
                            carry: Sequence[str] = (), leaf: Column | None = None) -> DataFrame:
    """M7 as :func:`snapshot_diff`, by a digest tree: worth it where changes lie close together.

    Each side is read once for the digests of its leaves. Rows of leaves that agree are the same
    on both sides, ``carry`` included, and come from ``prev`` alone, without a shuffle; only the
    rows of leaves that differ are joined. ``leaf`` is an int expression over the key with at most
    some thousands of values (default: a hash of the key), e.g. a range of an increasing key.
    """
    key = list(key)
    leaf = digest.leaf_of(key) if leaf is None else F.coalesce(leaf.cast("int"), F.lit(-1))
    parts = [materialize(digest.leaf_digests(side.select(*key, attr_hash(*tracked).alias("_h"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)]),
                                             key, ["_h", *[f"_c{i}" for i in range(len(carry))]], leaf=leaf), "digests")
             for side in (prev, cur)]
    among = leaf.isin(digest.differing_leaves(*parts))
    joined = snapshot_diff(prev.where(among), cur.where(among), key, tracked, carry)
    same = prev.where(~among).select(*key, F.lit(SAME).alias("change_type"), *[F.col(c).alias(f"prev_{c}") for c in carry],
                                     *[F.col(c).alias(f"cur_{c}") for c in carry])
    return joined.unionByName(same)
