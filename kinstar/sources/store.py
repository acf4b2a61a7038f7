"""Staging store: run-tagged snapshot tables and the run log (IO7-IO10, P1, P2).

Layout under a warehouse root (any Hadoop-compatible URI)::

    raw/<table>/run_id=<id>/part-*.parquet     one folder per run and table
    raw/etl_run_log/run_id=<id>/part-*.parquet one row per staged run

A run writes its own folder of each table, replacing what an earlier attempt of
the same run left there, and its run-log row last. So a run whose extraction
failed half-way has no log row, its rows are never selected, and it can simply
be repeated. Tables are read with a fixed schema (``run_id`` is text, however
much an id looks like a date or a number). A snapshot slice filters on the
partition column, so Spark prunes every other run's files before the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinstar.schemas import RAW, RUN_LOG

RUN_LOG_TABLE = "etl_run_log"


def raw_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/raw/{table}"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under a path (Hadoop content summary: file-system metadata, no
    job); 0 when the path does not exist."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def read_raw(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A staging table; an empty frame of the fixed schema when absent (IO10)."""
    schema = RUN_LOG if table == RUN_LOG_TABLE else RAW[table]
    path = raw_path(root, table)
    if not _exists(spark, path):
        empty = spark.createDataFrame([], schema)
        return empty if table == RUN_LOG_TABLE else empty.withColumn("run_id", F.lit(None).cast("string"))
    names = [f.name for f in schema.fields if f.name != "run_id"]
    fixed = T.StructType([T.StructField("run_id", T.StringType()), *[schema[c] for c in names]])
    return spark.read.schema(fixed).parquet(path).select("run_id", *names)


def partition_folder(spark: SparkSession, path: str, column: str, value: str) -> str:
    """The folder of one partition, as Spark would name it."""
    if not value:
        raise ValueError(f"{column} must not be empty")
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{path}/{column}={escape(value)}"


def run_folder(spark: SparkSession, root: str, table: str, run_id: str) -> str:
    """The folder of one run's rows of a staging table."""
    return partition_folder(spark, raw_path(root, table), "run_id", run_id)


def write_snapshot(root: str, table: str, rows: DataFrame, run_id: str) -> None:
    """IO7: a run's rows of one table, in place of any earlier attempt's."""
    (rows.select(*[F.col(f.name).cast(f.dataType) for f in RAW[table].fields])
     .write.mode("overwrite").parquet(run_folder(rows.sparkSession, root, table, run_id)))


def write_run_log(spark: SparkSession, root: str, run_id: str, started_at: dt.datetime) -> None:
    """IO8: the commit marker of an extraction, written after its rows."""
    row = spark.createDataFrame([(run_id, started_at)], RUN_LOG).select("started_at")
    row.coalesce(1).write.mode("overwrite").parquet(run_folder(spark, root, RUN_LOG_TABLE, run_id))


def current_run(run_log: DataFrame) -> DataFrame:
    """The run with the newest ``started_at``; ties broken by run_id so
    the choice is deterministic. A top-1 (TakeOrderedAndProject), no sort of
    the whole log."""
    return run_log.orderBy(F.col("started_at").desc_nulls_last(),
                           F.col("run_id").desc_nulls_last()).limit(1).select("run_id", "started_at")


def resolve_current_run(run_log: DataFrame) -> str | None:
    """The current run id as a driver-side literal (one row), so that
    snapshot slices are partition-pruned filters rather than joins."""
    row = current_run(run_log).first()
    return row["run_id"] if row else None


def snapshot_slice(raw: DataFrame, run_id: str) -> DataFrame:
    """The rows of one run, without the run column."""
    return raw.where(F.col("run_id") == F.lit(run_id)).drop("run_id")
