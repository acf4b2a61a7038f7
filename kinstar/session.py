"""Session helpers: configuration we rely on, and the checkpoint folder.

Everything here is a thin convenience over ``SparkSession``; the library's
operators take an existing session and never create their own.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the operators assume. Only applied by ``local_session`` (tests,
# bench); on a cluster the operator of the job owns the configuration.
LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "kinstar", extra: dict | None = None) -> SparkSession:
    """A ``local[cores]`` session for tests and the benchmark."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we read it
    and use it as is. Only a local-mode session (tests, bench) without one
    gets a fresh scratch folder of our own; a cluster session without one is
    an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            conf_dir = None
    if not conf_dir:
        if not sc.master.startswith("local"):
            # Executors must share the folder; a machine-local one would not do.
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        conf_dir = tempfile.mkdtemp(prefix="kinstar-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder of any Hadoop file system; False if there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p) and fs.delete(p, True))


_open_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that :func:`materialize` wrote inside, on leaving."""
    _open_scopes.append([])
    try:
        yield
    finally:
        for path in _open_scopes.pop():
            delete_path(spark, path)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage with a Parquet table in the shared checkpoint folder.

    Used where a result is read twice and must be identical both times. The
    table survives the loss of the executors that wrote it, is columnar and
    compressed (unlike a checkpoint, which keeps serialized rows), and goes
    with the enclosing ``scratch_scope``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _open_scopes:
        _open_scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, bound: int = 200_000) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``bound`` rows (counted),
    else as it is, so that Spark shuffles it."""
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df
