"""Recursive closure over an edge table.

Semantics of a recursive UNION ALL: one output row per *path*, without a depth
limit. On a cycle the recursion would never end, so a cycle is an error, found
exactly (see below).

``paths`` doubles. After round r it has all paths of lengths 1 .. n with n = 2^r, and
joins these behind those of length n, which gives lengths n+1 .. 2n. Rounds end when no
path has length n, so their number is the logarithm of the longest path's length, where
a join per generation takes as many as that. Every path is made once: a path of length
n + j is the one of its first n steps and the one of its last j.

Each round's new paths are a Parquet table in the shared checkpoint folder, which
cuts lineage and survives executor loss; a round is one job and reads of its
result. The only values that reach the driver are whether a path of the greatest
length is left and whether a path ends where it begins. A hot node (one
ancestor of a third of all paths) is a skewed key of a plain shuffle join, which
AQE splits, as nothing is aggregated between its exchange and the join.

Cycles: a path of the shortest cycle through any node ends where it begins, and has a
length of at most the number of its nodes; the round that makes it sees it. Without a
cycle no path ever does. A longer path would be made in a later round only.

A path carries its end nodes, its length, and one text: what ``step_text`` says of each
edge, joined by ``separator``. Texts of consecutive paths are joined the same way, a NULL
in either makes NULL, and callers attach further attributes once, afterwards.

``closure`` goes one generation per round, from given roots only and with values that each
step computes from the one before, for what two halves of a path cannot be put together from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinstar.session import materialize


class CycleError(RuntimeError):
    """A node is its own ancestor, so the closure would not end."""


def paths(edges: DataFrame, from_col: str, to_col: str, step_text: Column, separator: str,
          stats: dict | None = None) -> DataFrame:
    """(from_node, to_node, length, text) of every path of one or more edges; edges may
    repeat, and so do their paths. ``stats["rounds"]`` receives the number of joins."""
    cols = ["from_node", "to_node", "length", "text"]
    done = materialize(edges.where(F.col(from_col).isNotNull() & F.col(to_col).isNotNull()).select(
        F.col(from_col).alias("from_node"), F.col(to_col).alias("to_node"),
        F.lit(1).alias("length"), step_text.alias("text")), "paths")
    longest, n, rounds = done, 1, 0
    while True:
        # one look at the round's result: any path of the greatest length, any that returns
        seen = longest.agg(F.count_if(F.col("length") == n).alias("left"),
                           F.max(F.when(F.col("from_node") == F.col("to_node"), F.col("from_node"))).alias("looped")).first()
        if seen["looped"] is not None:
            raise CycleError(f"{seen['looped']!r} is its own ancestor")
        if not seen["left"]:
            break
        a, b = longest.where(F.col("length") == n).alias("a"), done.alias("b")
        longest = materialize(a.join(b, F.col("a.to_node") == F.col("b.from_node")).select(
            F.col("a.from_node").alias("from_node"), F.col("b.to_node").alias("to_node"),
            (F.col("a.length") + F.col("b.length")).alias("length"),
            F.concat(F.col("a.text"), F.lit(separator), F.col("b.text")).alias("text")), "paths").select(*cols)
        done, n, rounds = done.unionByName(longest), 2 * n, rounds + 1
    if stats is not None:
        stats["rounds"] = rounds
    return done


def closure(base: DataFrame, edges: DataFrame, root_col: str, node_col: str, from_col: str,
            to_col: str, next_values: dict[str, Column], depth_col: str = "depth") -> DataFrame:
    """Union of all levels. If every node with an edge is also a root, a cycle brings some root
    back to itself, and without a cycle no level ever holds a node that equals its root.

    ``base`` has ``root_col``, ``node_col``, ``depth_col`` (= 0) and the columns
    of ``next_values``, which gives those of level d+1 as expressions over the
    frontier (alias ``f``) and the edge (alias ``e``).
    """
    step = materialize(edges, "closure-edges")
    level = materialize(base, "closure-level")
    out = level
    while True:
        nxt = level.alias("f").join(step.alias("e"), F.col(f"f.{node_col}") == F.col(f"e.{from_col}"))
        level = materialize(nxt.select(
            F.col(f"f.{root_col}").alias(root_col),
            F.col(f"e.{to_col}").alias(node_col),
            (F.col(f"f.{depth_col}") + 1).alias(depth_col),
            *[v.alias(k) for k, v in next_values.items()],
        ).select(*base.columns), "closure-level")
        if level.isEmpty():
            return out
        looped = level.where(F.col(root_col) == F.col(node_col)).select(root_col).first()
        if looped is not None:
            raise CycleError(f"{looped[0]!r} is its own ancestor")
        out = out.unionByName(level)
