"""The incremental run (L1): snapshot -> staging -> dimensions -> fact.

``run_increment`` is a plain driver function that sequences DataFrame jobs:

1. extract: append the snapshot rows tagged with the run id, then the
   run-log row (the extraction's commit marker);
2. pick the current run from the log (newest ``started_at``) and slice the
   staging tables to it (partition pruning);
3. seed the role and calendar dimensions if anything is missing;
4. merge the person dimension (SCD-2) - current versions only;
5. derive the run's edges, enrich them with the *new* person dimension and
   merge the fact (insert / touch / revive / soft delete);
6. commit: one row per written table version in ``_commits``.

Storage. Plain Parquet has no UPDATE/MERGE, so every merged table is written
as a new version directory and only becomes visible through the commit log,
which is written last. A run that fails leaves nothing visible and can be
retried with the same run id, at whatever point it stopped: its staging rows
are replaced, or kept once the run log has them. A run that is committed is not
merged again. Versions are read back from
storage before the next step uses them (no long lineage, safe under executor
loss), and the run's intermediate tables are deleted when it ends.

* ``dim_person`` = one table of closed versions, in a folder per closing run
  (rows of committed runs count; they never change again), + one current
  version, so a run's cost does not grow with accumulated history.
* The current person versions are stored bucketed by ``person_id`` and the
  fact bucketed by ``edge_key`` (a hash of its 6-column natural key). The next
  run's merges (SCD-2 on person_id, the fact on edge_key - keys unique on both
  sides, so never skewed) then read the stored side without shuffling it: only
  the new snapshot / the run's edges move. The number of buckets stays as it is
  until the data need twice as many, and then doubles, so that each old bucket
  splits into exactly two files; inserts are hash-partitioned to match.
* Both tables are merge-on-read (``operators/layers.py``): a run writes the rows it
  changes as a delta, and the base anew only when the deltas together hold more than
  ``compact_share`` of the base's bytes.
* Each run leaves the digests of its person snapshot by leaves of the key
  (``operators/digest.py``). After a run the current versions are those of its
  snapshot, so the next run compares digests, and takes only the leaves that differ
  through the merge, and of the base only the buckets that hold them.
* ``fact_lifecycle`` holds the spans of runs that ended, in a folder per ending run: from
  the run that brought an edge (back) to the one that deleted it.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinstar.functions.columns import attr_hash
from kinstar.operators import checks, digest, dims, kinship, layers, scd2
from kinstar.operators import fact as fact_ops
from kinstar.operators.keys import next_key_base
from kinstar.schemas import EDGE_KEY, EDGE_NULLABLE_KEY, PERSON_TRACKED, TABLES
from kinstar.session import delete_path, materialize, scratch_scope
from kinstar.sources import store

COMMITS = "_commits"
COMMIT_SCHEMA = ("commit_seq long, run_id string, table_name string, path string, "
                 "bucket_col string, num_buckets int, high_water long, "
                 "committed_at timestamp_ntz, as_of timestamp_ntz")
# Stored layout of the logical tables.
HISTORY = "dim_person_history"
CLOSED_IN = "closed_in"  # partition column of the history and of the lifecycle: the closing run
LIFECYCLE = "fact_lifecycle"
DIGESTS = "dim_person_digests"
CURRENT, FACT = "dim_person_current", "fact_person_relationship"
STORED = {
    "dim_person": [HISTORY, CURRENT],
    "dim_relationship_role": ["dim_relationship_role"],
    "dim_date": ["dim_date"],
    FACT: [FACT],
}
SCHEMA_OF = {HISTORY: "dim_person", CURRENT: "dim_person"}
EXTRA_COLUMNS = {FACT: [T.StructField(fact_ops.EDGE_HASH, T.LongType()), T.StructField(layers.LIVE_SINCE, T.StringType())]}
DELTA = "_delta"  # a run's changes of a table, under the table's name and this
# Of the rows of a table that is stored as base and deltas: the bucket column, and the long
# that tells rows of one bucket value apart (persons need none).
LAYERED = {CURRENT: ("person_id", None), FACT: (fact_ops.EDGE_HASH, "relationship_sk")}
INTERVALS = T.StructType([*[T.StructField(c, TABLES[FACT][c].dataType) for c in layers.INTERVAL[:-2]],
                          T.StructField("from_run_id", T.StringType()), T.StructField("to_run_id", T.StringType())])
DIGEST_SCHEMA = "leaf int, n long, sum_a decimal(38,0), sum_b decimal(38,0)"


def stored_schema(name: str) -> T.StructType:
    name = name.removesuffix(DELTA)
    base = TABLES[SCHEMA_OF.get(name, name)]
    return T.StructType(base.fields + EXTRA_COLUMNS.get(name, []))


@dataclass
class Version:
    path: str
    bucket_col: str | None = None
    num_buckets: int | None = None
    high_water: int | None = None  # largest surrogate key in use (keyed tables)
    deltas: tuple[str, ...] = ()  # the runs' changes since this base, oldest first


def _table_name(path: str) -> str:
    return "kinstar_" + hashlib.sha1(path.encode()).hexdigest()[:20]


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


@dataclass
class Warehouse:
    """A warehouse rooted at a Hadoop-compatible path."""

    spark: SparkSession
    root: str
    _versions: dict[str, Version] | None = None
    _last: tuple = (None, None)

    def _commits_path(self) -> str:
        return f"{self.root.rstrip('/')}/wh/{COMMITS}"

    def commits(self) -> DataFrame:
        path = self._commits_path()
        if not store._exists(self.spark, path):
            return self.spark.createDataFrame([], COMMIT_SCHEMA)
        return self.spark.read.schema(COMMIT_SCHEMA).parquet(path)

    def latest_versions(self) -> dict[str, Version]:
        """stored table -> its newest committed version, with the deltas since; a row per table
        and one per run's delta, reduced by Spark, read once per Warehouse object."""
        if self._versions is None:
            version = F.struct("path", "bucket_col", "num_buckets", "high_water")
            found = self.commits().groupBy("table_name").agg(
                F.max_by(version, "commit_seq").alias("v"), F.max("commit_seq").alias("seq"),
                F.max_by(F.struct("run_id", "as_of"), "commit_seq").alias("run"),
                F.when(F.col("table_name").endswith(DELTA), F.sort_array(F.collect_list(
                    F.struct("commit_seq", "path", "high_water")))).alias("deltas")).collect()
            rows = {r["table_name"]: r for r in found}
            self._versions = {name: Version(*r["v"]) for name, r in rows.items() if not name.endswith(DELTA)}
            for name in LAYERED:
                if name in rows and name + DELTA in rows:
                    since = [d for d in rows[name + DELTA]["deltas"] if d["commit_seq"] > rows[name]["seq"]]
                    marks = [d["high_water"] for d in since if d["high_water"] is not None]
                    v = self._versions[name]
                    self._versions[name] = replace(v, deltas=tuple(d["path"] for d in since), high_water=max([v.high_water or 0, *marks]) if marks else v.high_water)
            self._last = max(((r["seq"], *r["run"]) for r in found), default=(0, None, None))[1:]
        return self._versions

    def last_run(self) -> tuple[str | None, dt.datetime | None]:
        """The newest committed run and its time stamp."""
        self.latest_versions()
        return self._last

    def read_version(self, name: str, v: Version, bucketed: bool = True) -> DataFrame:
        """A stored version; ``bucketed=False`` reads the files without the
        bucket layout (joins then shuffle both sides, which lets AQE split a
        skewed key)."""
        schema = stored_schema(name)
        if not v.bucket_col or not bucketed:
            return self.spark.read.schema(schema).parquet(v.path)
        # Bucketing lives in the catalog, not in the files: (re-)register the
        # version as an external bucketed table so scans keep its layout.
        tname = _table_name(v.path)
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {tname} ({cols}) USING parquet "
                       f"CLUSTERED BY (`{v.bucket_col}`) INTO {v.num_buckets} BUCKETS "
                       f"LOCATION '{_quoted(v.path)}'")
        return self.spark.table(tname)

    def read_buckets(self, name: str, v: Version, buckets: set[int]) -> DataFrame:
        """The rows of some buckets of a base: only their files are read."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(v.path)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        files = [s.getPath().toString() for s in fs.listStatus(path)]
        held = [f for f in files if (m := re.search(r"_(\d+)(?:\.c\d+)?(?:\.\w+)*$", f)) and f.rpartition("/")[2].startswith("part-") and int(m[1]) in buckets]
        schema = stored_schema(name)
        return self.spark.read.schema(schema).parquet(*held) if held else self.spark.createDataFrame([], schema)

    def delta_rows(self, name: str, v: Version) -> DataFrame | None:
        """The newest row of every key that some delta holds."""
        place, same = LAYERED[name]
        schema = stored_schema(name)
        return layers.newest([self.spark.read.schema(schema).parquet(p) for p in v.deltas], [same or place])

    def read_state(self, name: str, v: Version, bucketed: bool = True) -> DataFrame:
        """A table that is stored as base and deltas."""
        base = self.read_version(name, v, bucketed)
        delta = self.delta_rows(name, v)
        if delta is None:
            return base
        base = layers.not_replaced(base, delta, *LAYERED[name])
        return base.unionByName(delta.where("is_current") if name == CURRENT else delta)

    def stored(self, name: str) -> DataFrame | None:
        """One stored table; of the history and the lifecycle, the rows of committed runs."""
        version = self.latest_versions().get(name)
        if version is None:
            return None
        if name in LAYERED:
            state = self.read_state(name, version)
            return layers.as_read(state, *self.last_run()) if name == FACT else state
        if name not in (HISTORY, LIFECYCLE):
            return self.read_version(name, version)
        fields = INTERVALS.fields if name == LIFECYCLE else stored_schema(name).fields
        schema = T.StructType([*fields, T.StructField(CLOSED_IN, T.StringType())])
        runs = self.commits().where(F.col("table_name") == name).select(F.col("run_id").alias(CLOSED_IN)).distinct()
        return self.spark.read.schema(schema).parquet(version.path).join(runs, CLOSED_IN, "left_semi").drop(CLOSED_IN)

    def edge_intervals(self) -> DataFrame | None:
        """(relationship_sk, edge key, from_run_id, to_run_id): the spans of runs in which an edge was live,
        without an end if it still is."""
        version = self.latest_versions().get(FACT)
        if version is None:
            return None
        ended = self.stored(LIFECYCLE)
        live = layers.open_intervals(self.read_state(FACT, version))
        return live if ended is None else live.unionByName(ended)

    def table(self, name: str) -> DataFrame | None:
        """A logical warehouse table (dim_person = history parts + current),
        in its documented schema."""
        cols = [f.name for f in TABLES[name].fields]
        parts = [p.select(*cols) for p in (self.stored(s) for s in STORED.get(name, [name]))
                 if p is not None]
        if not parts:
            return None
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def high_water(self, name: str, sk_col: str, logical: str | None = None) -> int:
        """Largest surrogate key ever assigned: recorded in the commit log
        with each version, so no scan of the table. Only a version without
        the record is scanned, across the whole ``logical`` table (a closed
        history row may hold the largest key)."""
        version = self.latest_versions().get(name)
        if version is None:
            return 0
        if version.high_water is not None:
            return version.high_water
        return next_key_base(self.table(logical or name), sk_col)

    def write_version(self, name: str, df: DataFrame, bucket_col: str | None = None,
                      num_buckets: int | None = None, high_water: int | None = None) -> Version:
        path = f"{self.root.rstrip('/')}/wh/{name}/v-{uuid.uuid4().hex}"
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in stored_schema(name).fields])
        if bucket_col:
            (df.write.bucketBy(num_buckets, bucket_col).mode("overwrite")
             .option("path", path).saveAsTable(_table_name(path)))
        else:
            df.write.mode("overwrite").parquet(path)
        return Version(path, bucket_col, num_buckets, high_water)

    def write_closed(self, name: str, rows: DataFrame, run_id: str) -> tuple[Version, str]:
        """A run's rows of the history or the lifecycle, in place of an earlier attempt's; also their folder."""
        path = f"{self.root.rstrip('/')}/wh/{name}"
        folder = store.partition_folder(self.spark, path, CLOSED_IN, run_id)
        rows.write.mode("overwrite").parquet(folder)
        return Version(path), folder

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete versions of the rewritten tables other than the newest
        ``keep`` committed ones of each and the deltas on top of them, those that
        failed runs left behind included. Call between runs (one active run at a time). Returns the
        deleted paths."""
        if keep < 1:
            raise ValueError("keep must be >= 1")
        named = [t for tables in STORED.values() for t in tables if t != HISTORY]
        newest = (self.commits().where(F.col("table_name").isin([*named, *[t + DELTA for t in LAYERED]])).groupBy("table_name")
                  .agg(F.sort_array(F.collect_set(F.struct("commit_seq", "path")), asc=False).alias("v")))
        versions = {r["table_name"]: r["v"] for r in newest.collect()}
        kept = {name: {v["path"].rpartition("/")[2] for v in versions[name][:keep]} for name in versions if name in named}
        for name in LAYERED:  # the deltas on top of the bases that stay
            if name in kept:
                since = versions[name][:keep][-1]["commit_seq"]
                kept[name + DELTA] = {v["path"].rpartition("/")[2] for v in versions.get(name + DELTA, []) if v["commit_seq"] > since}
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        deleted = []
        for name in [*named, *[t + DELTA for t in LAYERED]]:
            folder = f"{self.root.rstrip('/')}/wh/{name}"
            p = jvm.org.apache.hadoop.fs.Path(folder)
            fs = p.getFileSystem(conf)
            for status in fs.listStatus(p) if fs.exists(p) else []:
                version = status.getPath().getName()
                if version not in kept.get(name, ()):
                    path = f"{folder}/{version}"
                    self.spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")  # metadata only
                    if delete_path(self.spark, path):
                        deleted.append(path)
        return deleted

    def commit(self, run_id: str, written: dict[str, Version], as_of: dt.datetime | None = None) -> None:
        if not written:
            return
        seq = self.commits().agg(F.max("commit_seq")).first()[0] or 0
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        rows = [(seq + i + 1, run_id, t, v.path, v.bucket_col, v.num_buckets, v.high_water, now, as_of)
                for i, (t, v) in enumerate(sorted(written.items()))]
        (self.spark.createDataFrame(rows, COMMIT_SCHEMA).coalesce(1)
         .write.mode("append").parquet(self._commits_path()))
        self._versions = None


@dataclass
class RunResult:
    run_id: str
    current_run: str
    written: dict[str, Version] = field(default_factory=dict)


def extract(spark: SparkSession, root: str, person: DataFrame, family: DataFrame,
            relation: DataFrame, run_id: str, started_at: dt.datetime) -> bool:
    """Stage one snapshot; False when this run was already staged."""
    log = store.read_raw(spark, root, store.RUN_LOG_TABLE)
    if not log.where(F.col("run_id") == run_id).isEmpty():
        return False
    store.write_snapshot(root, "raw_person_snapshot", person, run_id)
    store.write_snapshot(root, "raw_family_snapshot", family, run_id)
    store.write_snapshot(root, "raw_relation_snapshot", relation, run_id)
    store.write_run_log(spark, root, run_id, started_at)
    return True


# Stored (compressed) bytes that a bucket may hold. A bucket is one task of the merges, which
# sorts its rows; kinship edges take some 5 bytes each in storage and 350 there.
BYTES_PER_BUCKET = 4 << 20
# Stored edges per stored relation byte, as a first-run size guess for the
# fact (spouse pairs, both parent/child directions, sibling pairs).
EDGE_EXPANSION = 4


def bucket_count(total_bytes: int, previous: int | None = None) -> int:
    """Buckets of a new version: the previous number, doubled until a bucket
    holds at most BYTES_PER_BUCKET."""
    n = previous or 1
    while n * BYTES_PER_BUCKET < total_bytes:
        n *= 2
    return n


# Lets a bucketed side satisfy a join whose keys include its bucket column.
# The fact is bucketed by a hash of its whole key, so this cannot concentrate
# rows; without it Spark would re-shuffle the stored side.
CO_PARTITION_CONF = "spark.sql.requireAllClusterKeysForCoPartition"
# What holds for the time of a run. A task takes shuffle blocks by their compressed bytes, of which
# kinship rows take very few: by default a run's tasks would be as many as there are cores, however
# many edges there are, each with all of its joins' sorts in memory.
RUN_CONF = {
    CO_PARTITION_CONF: "false",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
}


# A base is written anew when the deltas hold more than this share of its bytes.
COMPACT_SHARE = 0.25


def run_increment(spark: SparkSession, root: str, person: DataFrame, family: DataFrame,
                  relation: DataFrame, run_id: str | None = None,
                  started_at: dt.datetime | None = None,
                  as_of: dt.datetime | None = None, buckets: int | None = None,
                  validate: bool = True, compact_share: float = COMPACT_SHARE) -> RunResult:
    """One incremental run over a full snapshot (person, family, relation
    in the staging schema). ``as_of`` stamps created_at / updated_at;
    ``buckets`` fixes the bucket count of new versions; by default it is that of
    the previous version, doubled while its bytes and the snapshot's exceed
    ``BYTES_PER_BUCKET`` each. ``validate`` checks the snapshot's keys before
    any merge and what the run changes before the commit (V1), and raises
    ``ConstraintViolation`` without committing anything. ``compact_share`` is the
    share of a base's bytes beyond which its deltas are merged into a new base."""
    run_id = run_id or str(uuid.uuid4())
    started_at = started_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    as_of = as_of or started_at
    extract(spark, root, person, family, relation, run_id, started_at)

    previous = {name: spark.conf.get(name, None) for name in RUN_CONF}
    for name, value in RUN_CONF.items():
        spark.conf.set(name, value)
    try:
        with scratch_scope(spark):
            return _merge_run(spark, root, buckets, as_of, run_id, validate, compact_share)
    finally:
        for name, value in previous.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@dataclass
class _Run:
    """One run over one warehouse, as its steps share it."""

    wh: Warehouse
    run_id: str
    as_of: dt.datetime
    compact_share: float
    written: dict[str, Version] = field(default_factory=dict)

    def read(self, name: str) -> DataFrame:
        return self.wh.read_version(name, self.written[name]) if name in self.written else self.wh.stored(name)

    def write_layer(self, name: str, changes: DataFrame, buckets: int, high_water: int) -> tuple[DataFrame, Version]:
        """Write a run's changed rows: as the base if there is none, else as a delta, and the base anew
        if the deltas have grown too large. Returns the rows as stored, and the table's new version."""
        wh, spark, old = self.wh, self.wh.spark, self.wh.latest_versions().get(name)
        place, same = LAYERED[name]
        if old is None:
            rows = changes.repartition(buckets, place)
            new = self.written[name] = wh.write_version(name, rows, place, buckets, high_water)
            return wh.read_version(name, new, bucketed=False), new
        delta = wh.write_version(name + DELTA, changes, high_water=high_water)
        stored = spark.read.schema(stored_schema(name)).parquet(delta.path)
        new = replace(old, deltas=(*old.deltas, delta.path), high_water=high_water)
        held = sum(store.stored_bytes(spark, p) for p in new.deltas)
        if buckets == old.num_buckets and held <= self.compact_share * store.stored_bytes(spark, old.path):
            if stored.isEmpty():
                delete_path(spark, delta.path)
                return stored.limit(0), old
            self.written[name + DELTA] = delta
            return stored, new
        changed = materialize(stored, "changes")
        latest = wh.delta_rows(name, new)
        kept = layers.not_replaced(wh.read_version(name, old), latest, place, same)
        if name == CURRENT:
            latest = latest.where("is_current")
        new = self.written[name] = wh.write_version(name, kept.unionByName(latest.repartition(buckets, place)), place, buckets, high_water)
        delete_path(spark, delta.path)
        return changed, new


def _merge_run(spark: SparkSession, root: str, buckets: int | None, as_of: dt.datetime,
               run_id: str, validate: bool = True, compact_share: float = COMPACT_SHARE) -> RunResult:
    current = store.resolve_current_run(store.read_raw(spark, root, store.RUN_LOG_TABLE))
    wh = Warehouse(spark, root)
    if not wh.commits().where(F.col("run_id") == current).isEmpty():
        return RunResult(run_id=run_id, current_run=current)  # merged before: nothing to do
    run = _Run(wh, current, as_of, compact_share)

    def sized(table: str, raw_table: str, factor: int = 1) -> int:
        if buckets:
            return buckets
        prev = wh.latest_versions().get(table)
        total = factor * store.stored_bytes(spark, store.run_folder(spark, root, raw_table, current))
        if prev is None:
            return bucket_count(total)
        return bucket_count(total + store.stored_bytes(spark, prev.path), prev.num_buckets)

    person_s = store.snapshot_slice(store.read_raw(spark, root, "raw_person_snapshot"), current)
    family_s = store.snapshot_slice(store.read_raw(spark, root, "raw_family_snapshot"), current)
    relation_s = store.snapshot_slice(store.read_raw(spark, root, "raw_relation_snapshot"), current)
    if validate:
        # V1: node ids are unique and present (the merges rely on it), and
        # both ends of every relation are given.
        checks.assert_valid(
            checks.key_summary(person_s, "raw_person_snapshot", ["person_id"])
            .unionByName(checks.key_summary(family_s, "raw_family_snapshot", ["family_id"]))
            .unionByName(checks.null_summary(relation_s, "raw_relation_snapshot",
                                             ["person_id", "family_id", "relationship_type"])))

    # Reference dimensions: a new version only when seeding adds rows.
    role_old = wh.stored("dim_relationship_role")
    if role_old is None or not (dims.role_rows(spark)
                                .join(role_old, "relationship_role_code", "left_anti").isEmpty()):
        run.written["dim_relationship_role"] = wh.write_version(
            "dim_relationship_role", dims.role_dimension(spark, role_old))
    date_old = wh.stored("dim_date")
    if date_old is None or not (dims.date_dimension(spark)
                                .join(date_old.select("full_date"), "full_date", "left_anti")
                                .isEmpty()):
        run.written["dim_date"] = wh.write_version("dim_date", dims.seed_calendar(spark, date_old))

    persons, dim_checks = _merge_persons(run, person_s, sized(CURRENT, "raw_person_snapshot"))
    # The person lookups read the dimension unbucketed: edges can be heavily skewed on one
    # person (a parent of a third of all children), and AQE splits a skewed join only when both
    # sides are shuffled. The fact merge keeps the bucketed read: its key is unique on both sides.
    edges = kinship.derive_edges(person_s, family_s, relation_s)
    flagged = kinship.enrich_edges(edges, wh.read_state(CURRENT, persons, bucketed=False),
                                   run.read("dim_relationship_role"), run.read("dim_date"),
                                   keep_unmatched=True)
    fact_checks = _merge_fact(run, flagged, sized(FACT, "raw_relation_snapshot", EDGE_EXPANSION))
    if validate:
        checks.assert_valid(dim_checks.unionByName(fact_checks))
    wh.commit(current, run.written, as_of)
    return RunResult(run_id=run_id, current_run=current, written=run.written)


def _merge_persons(run: _Run, person_s: DataFrame, buckets: int) -> tuple[Version, DataFrame]:
    """Merge the person dimension: only leaves of the key whose digests are not those of the last run,
    and of the base only the buckets that hold them. Returns the new version and its checks."""
    wh, spark = run.wh, run.wh.spark
    old, key = wh.latest_versions().get(CURRENT), "person_id"
    leaves = buckets * max(1, digest.LEAVES // buckets)
    path = f"{run.wh.root.rstrip('/')}/wh/{DIGESTS}/v-{uuid.uuid4().hex}"
    digest.leaf_digests(person_s.select(key, attr_hash(*PERSON_TRACKED).alias("h")), [key], ["h"], leaves).coalesce(1).write.parquet(path)
    run.written[DIGESTS] = Version(path, num_buckets=leaves)
    before = wh.latest_versions().get(DIGESTS)
    snap, current, base = person_s, None, None
    if old is not None:
        current = wh.read_state(CURRENT, old)
        if before is not None and before.num_buckets == leaves and old.num_buckets == buckets:
            last, new = (spark.read.schema(DIGEST_SCHEMA).parquet(p) for p in (before.path, path))
            differing = digest.differing_leaves(last, new)
            among = digest.leaf_of([key], leaves).isin(differing)
            snap = person_s.where(among | F.col(key).isNull())
            held = {leaf % buckets for leaf in differing}
            if len(held) < buckets:
                base = wh.read_buckets(CURRENT, old, held)
                delta = wh.delta_rows(CURRENT, old)
                current = base if delta is None else layers.not_replaced(base, delta, key).unionByName(delta.where("is_current"))
            current = current.where(among)
    else:
        current = scd2.empty_dimension(person_s, key, PERSON_TRACKED, "person_sk")
    # Keys continue after the largest ever assigned (history included),
    # which the commit log records.
    stats: dict = {}
    key_base = wh.high_water(CURRENT, "person_sk", "dim_person")
    _, inserted, closed = scd2.scd2_parts(current, snap, run.run_id, run.as_of, key=key, tracked=PERSON_TRACKED,
                                          sk_col="person_sk", key_base=key_base, stats=stats)
    cols = [f.name for f in TABLES["dim_person"].fields]
    run.written[HISTORY], folder = wh.write_closed(HISTORY, closed.select(*[F.col(c).cast(TABLES["dim_person"][c].dataType) for c in cols]), run.run_id)
    closed = spark.read.schema(stored_schema(HISTORY)).parquet(folder)
    gone = closed.join(inserted.select(key), key, "left_anti").select(*cols)
    changes, new = run.write_layer(CURRENT, inserted.select(*cols).unionByName(gone), buckets, stats["high_water"])
    inserted = changes.where("is_current")
    # an inserted version's key has no other current version: the base's, if any, was closed
    found = [checks.key_summary(changes, CURRENT, [key], [f.name for f in TABLES["dim_person"].fields if not f.nullable]),
             checks.key_summary(inserted, CURRENT, ["person_sk"]),
             checks.range_summary(inserted, CURRENT, "person_sk", key_base, stats["high_water"])]
    if old is not None:
        had = current.select(F.col(key).alias("_had"), F.col("person_sk").alias("_had_sk"))
        left = closed.select(F.col("person_sk").alias("_closed"))
        twice = inserted.join(had, F.col(key) == F.col("_had")).join(left, F.col("_had_sk") == F.col("_closed"), "left_anti")
        found.append(checks.none_summary(twice, CURRENT, [key]))
    return new, checks.union(found)


def _merge_fact(run: _Run, flagged: DataFrame, buckets: int) -> DataFrame:
    """Merge the fact: write the rows that the run changes, and the spans that it ends. Returns the checks."""
    wh, old, stats = run.wh, run.wh.latest_versions().get(FACT), {}
    edges = materialize(layers.renamed_edges(flagged), "edges")
    key_base = wh.high_water(FACT, "relationship_sk")
    base = delta = None
    state = []
    if old is not None:
        base, delta = wh.read_version(FACT, old), wh.delta_rows(FACT, old)
        state = [layers.not_replaced(base, delta, *LAYERED[FACT]), *([delta] if delta is not None else [])]
    known = [] if base is None else [base, *([delta] if delta is not None else [])]
    inserted = layers.fact_inserts(edges, known, run.run_id, run.as_of, key_base, stats)
    changes = inserted
    if state:
        changes = inserted.unionByName(layers.fact_changes(state, edges, run.run_id, run.as_of, *wh.last_run()))
    changes, _ = run.write_layer(FACT, changes, buckets, stats["high_water"])
    run.written[LIFECYCLE], _ = wh.write_closed(LIFECYCLE, layers.ended_intervals(changes, run.run_id), run.run_id)

    # Key parts that may be NULL count as equal; the group-by is exact on them.
    key = [fact_ops.KEY_IN_FACT[k] for k in EDGE_KEY]
    open_ = ("last_seen_run_id", "updated_at")  # NULL in open rows
    fresh = changes.where(F.col("relationship_sk") > key_base)
    found = [checks.key_summary(changes, FACT, ["relationship_sk"], [f.name for f in TABLES[FACT].fields if not f.nullable and f.name not in open_]),
             checks.key_summary(changes, FACT, key, nullable=EDGE_NULLABLE_KEY),
             checks.range_summary(fresh, FACT, "relationship_sk", key_base, stats["high_water"])]
    for part in known:  # inserted keys against the stored ones
        same = fresh.select(*[F.col(c).alias(f"_e_{c if c != 'source_relationship_role_code' else 'relationship_role_code'}") for c in key],
                            F.col(fact_ops.EDGE_HASH).alias(f"_e_{fact_ops.EDGE_HASH}"))
        found.append(checks.none_summary(part.join(same, layers.edge_condition(), "left_semi"), FACT, key))
    return checks.union(found)


def table_checks(current: DataFrame, fact: DataFrame) -> DataFrame:
    """V1 on the merged tables: the surrogate keys are unique, a person has one
    current version, and a fact row is the only one of its 6-column key."""
    # Key parts that may be NULL count as equal; the group-by is exact on them.
    key = [fact_ops.KEY_IN_FACT[k] for k in EDGE_KEY]
    not_null = [f.name for f in TABLES["fact_person_relationship"].fields if not f.nullable]
    return (checks.key_summary(current, "dim_person_current", ["person_id"],
                               [f.name for f in TABLES["dim_person"].fields if not f.nullable])
            .unionByName(checks.key_summary(current, "dim_person_current", ["person_sk"]))
            .unionByName(checks.key_summary(fact, "fact_person_relationship", ["relationship_sk"], not_null))
            .unionByName(checks.key_summary(fact, "fact_person_relationship", key, nullable=EDGE_NULLABLE_KEY)))


def table_summary(spark: SparkSession, root: str) -> DataFrame:
    """Row counts per warehouse and staging table (for run checks)."""
    wh = Warehouse(spark, root)
    parts = []
    for name in ["dim_person", "dim_relationship_role", "dim_date", "fact_person_relationship"]:
        t = wh.table(name)
        if t is None:
            continue
        if name == "dim_person":
            live, gone = F.col("is_current"), F.col("is_deleted")
        elif name == "fact_person_relationship":
            live, gone = ~F.col("is_deleted"), F.col("is_deleted")
        else:
            live, gone = F.lit(True), F.lit(False)
        parts.append(t.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                           F.count_if(live).alias("n_live"), F.count_if(gone).alias("n_deleted")))
    for name in [*store.RAW, store.RUN_LOG_TABLE]:
        t = store.read_raw(spark, root, name)
        parts.append(t.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                           F.count(F.lit(1)).alias("n_live"), F.lit(0).cast("long").alias("n_deleted")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
