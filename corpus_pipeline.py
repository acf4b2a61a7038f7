"""A training corpus from ``documents``, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet in the shared checkpoint folder and read again as the next one's docs.
All but the last return the columns of ``documents``:

1. toxicity: documents that the ordinal model calls toxic go;
2. near_duplicates: one document of each group of near copies stays (the one
   with the smallest id; five-word shingles, similarity 0.8 or more);
3. decontamination: documents that hold a benchmark item go;
4. secrets: every secret is replaced by ``[SECRET]``, and ``n_chars`` follows;
5. packing: the texts' tokens are packed into windows of 1024; a row holds the
   token ids of its piece.

Columns of ``documents`` beyond those above pass unchanged, whatever they are called. Null
and empty texts stay (they are neither toxic nor copies); of rows that repeat an id and a
text one stays, rows that share an id with different texts are documents of their own, and
rows with a null id are never copies; texts are taken whole, however long; empty tables
give empty results.

Texts go to the Python workers in Arrow batches of at most ``BATCH_BYTES`` (one text if it is
longer): a batch is held several times over, in Spark's memory and in Python's. By rows alone, of
which Spark takes 10,000, a batch is as large as the texts are long. It is a setting of the session,
as a stage's rows are read only after it has returned; one that the session has already stays.

A stage has no SQL form if it rests on a trained model, and so the pipeline has
none; tests/llm/test_pipeline.py compares it with a brute-force version.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinstar.llm import decontaminate, near_dup, packing, secrets, toxicity
from kinstar.llm.graph import stored

NEAR = {"k": 5, "num": 80, "den": 100}
BATCH_BYTES = 4 << 20


def in_small_batches(stage):
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
            spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)
    return run


@in_small_batches
def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


@in_small_batches
def copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    drop = near_dup.near_duplicates(docs, **NEAR).where("not kept").select("doc_id").distinct()
    if docs.groupBy("doc_id").count().where("count > 1 and doc_id is not null").limit(1).count():
        # rows that repeat an id and a text whole are one document
        docs = docs.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).unionByName(docs.where("doc_id is null"))
    # a merge join whatever the sizes: a corpus has too many copies to broadcast their ids
    return docs.hint("merge").join(drop, "doc_id", "left_anti").select(*docs.columns)


@in_small_batches
def leaks_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@in_small_batches
def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secrets.redact(docs, secrets.train(docs))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@in_small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", toxic_out), ("near_duplicates", copies_out), ("decontamination", leaks_out),
          ("secrets", secrets_masked), ("packing", packed)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
