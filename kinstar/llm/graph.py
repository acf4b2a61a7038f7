"""Connected components on links, as alternating star contractions.

Every round replaces the links by links to smaller neighbours (first from each
vertex to its larger neighbours, then to its smaller ones); the rounds end when
nothing changes, and then each vertex is linked with the smallest one of its
component. Rounds grow with the logarithm of the longest chain. All links stay
in tables in the shared checkpoint folder; the driver sees two numbers a round.

A vertex may have any number of neighbours: what was found for it goes back to its
links in ``SALTS`` parts, dealt by the other end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinstar.session import scratch_path


#: Parts into which the links of a vertex are dealt (at most 63).
SALTS = 32


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared checkpoint folder and read back (cuts the lineage;
    survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete a table of :func:`stored` that nothing reads any more."""
    spark: SparkSession = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _part(end: str):
    return F.pmod(F.xxhash64(end), F.lit(SALTS)).cast("int")


def _part_bit(end: str):
    return F.call_function("shiftleft", F.lit(1).cast("long"), _part(end)).alias("bit")


def _met(links: DataFrame, at: str, other: str, found: DataFrame) -> DataFrame:
    """``links`` with the ``m`` of ``found`` for their vertex ``at``; ``parts`` has a bit for each
    part of the vertex's links."""
    salts = F.expr(f"filter(sequence(0, {SALTS - 1}), s -> bit_get(parts, s) = 1)")
    spread = found.select("v", "m", F.explode(salts).alias("part"))
    return links.withColumn("part", _part(other)).join(spread.withColumnRenamed("v", at), [at, "part"]).drop("part")


def connected_components(links: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(id, component) of every vertex with a link to another one; component is
    the smallest id reachable. Self links and null ends are ignored."""
    hi, lo = F.greatest(src, dst).alias("hi"), F.least(src, dst).alias("lo")
    edges = stored(links.where(F.col(src) != F.col(dst)).select(hi, lo).distinct(), "cc")
    mark = None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first()
        if tuple(seen) == mark:
            return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component")).union(
                edges.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct())
        mark = tuple(seen)
        # larger neighbours of a vertex go to the smallest of its neighbourhood
        least = edges.select(F.col("lo").alias("v"), F.col("lo").alias("m"), _part_bit("hi")).union(
            edges.select("hi", "lo", F.lit(0).cast("long"))).groupBy("v").agg(F.min("m").alias("m"), F.bit_or("bit").alias("parts"))
        large = _met(edges, "lo", "hi", least).select("hi", F.col("m").alias("lo"))
        # then the smaller neighbours, and the vertex itself
        low = large.groupBy(F.col("hi").alias("v")).agg(F.min("lo").alias("m"), F.bit_or(_part_bit("lo")).alias("parts"))
        met = _met(large, "hi", "lo", low)
        small = met.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(
            low.select(F.col("v").alias("hi"), F.col("m").alias("lo"))).distinct()
        following = stored(small, "cc")
        drop_stored(edges)
        edges = following
