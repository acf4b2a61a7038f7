"""Path doubling against the closure by generations."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from kinstar.operators import closure


def test_paths_equal_the_generations(spark):
    rng = random.Random(4)
    edges = [(a, b) for a in range(40) for b in rng.sample(range(a + 1, 44), 2) if b < 42] + [(3, 9), (3, 9)]
    df = spark.createDataFrame(edges, "src int, dst int")
    got = closure.paths(df, "src", "dst", F.when(F.col("dst") != 40, F.col("dst").cast("string")), "-")
    base = spark.range(44).select(F.col("id").cast("int").alias("root"), F.col("id").cast("int").alias("node"), F.lit(0).alias("depth"),
                                  F.lit("").alias("text"))
    step = F.when(F.col("e.dst") != 40, F.col("e.dst").cast("string"))
    want = closure.closure(base, df, "root", "node", "src", "dst", {"text": F.concat("f.text", F.lit("-"), step)}).where("depth > 0")
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(
        str((r.root, r.node, r.depth, None if r.text is None else r.text[1:])) for r in want.collect())


@pytest.mark.parametrize("depth", [1, 2, 7, 33])
def test_rounds_grow_with_the_logarithm_of_the_depth(spark, depth):
    stats: dict = {}
    df = spark.range(depth).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    found = closure.paths(df, "src", "dst", F.lit("x"), "", stats)
    assert found.count() == depth * (depth + 1) // 2 and stats["rounds"] <= math.log2(depth) + 2


def test_cycles_raise_and_nothing_gives_nothing(spark):
    schema = "src int, dst int"
    for edges in ([(1, 1)], [(1, 2), (2, 3), (3, 1)], [(0, 1), (1, 2), (2, 3), (3, 4), (4, 5), (5, 1)]):
        with pytest.raises(closure.CycleError):
            closure.paths(spark.createDataFrame(edges, schema), "src", "dst", F.lit("x"), "")
    assert closure.paths(spark.createDataFrame([], schema), "src", "dst", F.lit("x"), "").collect() == []
    assert closure.paths(spark.createDataFrame([(None, 1), (1, None)], schema), "src", "dst", F.lit("x"), "").collect() == []
