"""Changesets on node and edge tables.

The user-level equivalents of graph edits, as DataFrame -> DataFrame
functions over the staging-shaped node and edge tables. Each is one
(semi/anti/left) join on the key, so it partitions by that key and scales
with the tables; nothing is applied row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EDGE_IDENTITY = ["person_id", "family_id", "relationship_type", "role"]


def insert_nodes_if_absent(nodes: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Add nodes whose id is unseen; existing nodes are never overwritten."""
    fresh = new.join(nodes.select(key), key, "left_anti")
    return nodes.unionByName(fresh.select(*nodes.columns))


def insert_edges_if_absent(edges: DataFrame, new: DataFrame, persons: DataFrame,
                           families: DataFrame) -> DataFrame:
    """Add edges whose two ends exist and that are not present yet
    (same ends, type and properties; a missing role matches a missing role)."""
    cand = (new.join(persons.select("person_id"), "person_id", "left_semi")
            .join(families.select("family_id"), "family_id", "left_semi")
            .select(*EDGE_IDENTITY).distinct())
    cond = None
    for k in EDGE_IDENTITY:
        t = F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}"))
        cond = t if cond is None else cond & t
    fresh = cand.alias("n").join(edges.select(*EDGE_IDENTITY).alias("o"), cond, "left_anti")
    return edges.unionByName(fresh.select(*edges.columns))


def update_properties(nodes: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Overwrite the properties named by ``changes``' columns on matched
    nodes (a NULL value removes the property); unmatched changes do nothing."""
    props = [c for c in changes.columns if c != key]
    ch = changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in props],
                        F.lit(True).alias("_hit"))
    j = nodes.join(ch, key, "left")
    hit = F.col("_hit").isNotNull()
    return j.select(*[
        F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)).cast(nodes.schema[c].dataType).alias(c)
        if c in props else F.col(c)
        for c in nodes.columns])


def delete_edges(edges: DataFrame, to_delete: DataFrame,
                 keys: Sequence[str] = ("person_id", "family_id", "relationship_type")) -> DataFrame:
    """Remove the matched edges only."""
    return edges.join(to_delete.select(*keys), list(keys), "left_anti")
