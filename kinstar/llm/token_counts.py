"""Token counts from flat, unindexed token files, by a separator scan.

A token file is nothing but ids, each document's followed by the end-of-document
id, in the narrowest unsigned width that holds the vocabulary. To count, files
are cut into blocks of ``BLOCK`` ids without regard to documents; each block is
searched for the separator in one vectorised comparison. Boundaries are then
stitched with a prefix scan over the blocks of a file: the number of separators
before a block numbers its documents, and the last separator before it says
where the document begins that runs into it. A last document without a
separator is counted, too.

``write_token_files`` makes such files (temporary names, then a rename, so that
repeated tasks are harmless) and returns which document lies where; the scan
itself uses only the files.

Defined cases: null and empty texts have no tokens; separator strings in a text
are ordinary text; an empty table gives no files and no rows; repeated rows are
counted each; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinstar.llm.files import NewFile, file_size, open_file
from kinstar.llm.graph import stored
from kinstar.llm.tokens import bpe_encoder

#: Ids of a block of the scan.
BLOCK = 1 << 20
#: Ids after which a token file is closed, at the end of a document.
FILE = 1 << 26


def id_width(vocabulary: int) -> int:
    return 2 if vocabulary <= 1 << 16 else 4


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, width: int,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise ``docs`` into flat files; returns (file, ordinal, doc_id) in file order."""
    def run(batches):
        encode = bpe_encoder(tokenizer, True)
        end = np.array([end_id], dtype=f"<u{width}").tobytes()
        current, count, part = None, 0, 0
        held: list[list] = []

        def close():
            nonlocal current, count, part
            name = f"tokens-{TaskContext.get().partitionId():06d}-{part:05d}.bin"
            current.commit(name)
            ids = [key for keys in held for key in keys]
            held.clear()
            current, count, part = None, 0, part + 1
            return pa.RecordBatch.from_arrays(
                [pa.array([name] * len(ids), pa.string()), pa.array(range(len(ids)), pa.int64()), pa.array(ids, pa.int64())],
                names=["file", "ordinal", "doc_id"])

        for batch in batches:
            keys: list = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                current = current or NewFile(folder)
                ids = np.frombuffer(encode(text.as_py() or ""), dtype="<u4").astype(f"<u{width}")
                current.write(ids.tobytes() + end)
                keys.append(key)
                count += len(ids) + 1
                if count >= FILE:
                    held.append(keys)
                    keys = []
                    yield close()
            held.append(keys)
        if current is not None:
            yield close()

    return stored(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "file string, ordinal long, doc_id long"), "token-files")


def scan_token_files(spark: SparkSession, folder: str, files: DataFrame, end_id: int, width: int) -> DataFrame:
    """(file, ordinal, start, n_tokens) of every document of the files (column ``file``)."""
    def sized(batches):
        for batch in batches:
            names = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([file_size(folder, n) // width for n in names], pa.int64())],
                names=["file", "ids"])

    def search(batches):
        for batch in batches:
            for name, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                with open_file(folder, name) as stream:
                    stream.seek(offset * width)
                    ids = np.frombuffer(stream.read(length * width), dtype=f"<u{width}")
                at = np.flatnonzero(ids == end_id) + offset
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name], pa.string()), pa.array([offset], pa.int64()), pa.array([length], pa.int64()),
                     pa.array([at], pa.list_(pa.int64()))], names=["file", "offset", "length", "ends"])

    whole = files.select("file").distinct().mapInArrow(sized, "file string, ids long").where("ids > 0")
    cut = whole.withColumn("offset", F.explode(F.sequence(F.lit(0), F.col("ids") - 1, F.lit(BLOCK)))).select(
        "file", "offset", F.least(F.lit(BLOCK), F.col("ids") - F.col("offset")).alias("length"))
    found = stored(cut.repartition("file", "offset").mapInArrow(
        search, "file string, offset long, length long, ends array<long>"), "separators")
    # the prefix scan: one row per block
    before = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.select("file", "offset", F.size("ends").cast("long").alias("n"), F.array_max("ends").alias("last"))
    stitched = stitched.select("file", "offset", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"),
                               (F.coalesce(F.max("last").over(before), F.lit(-1)) + 1).alias("begin"))
    ends = found.join(stitched, ["file", "offset"]).select(
        "file", "first", F.posexplode(F.arrays_zip(
            F.concat(F.array("begin"), F.transform("ends", lambda x: x + 1)).alias("start"),
            F.concat("ends", F.array(F.lit(None).cast("long"))).alias("end"))).alias("i", "span"))
    closed = ends.where("span.end is not null").select(
        "file", (F.col("first") + F.col("i")).alias("ordinal"), F.col("span.start").alias("start"),
        (F.col("span.end") - F.col("span.start")).alias("n_tokens"))
    # what follows the last separator of a file
    total = found.groupBy("file").agg(F.max(F.col("offset") + F.col("length")).alias("stop"),
                                      F.coalesce(F.max(F.array_max("ends")), F.lit(-1)).alias("last"),
                                      F.sum(F.size("ends")).alias("ordinal"))
    tail = total.where("last < stop - 1").select("file", "ordinal", (F.col("last") + 1).alias("start"),
                                                 (F.col("stop") - F.col("last") - 1).alias("n_tokens"))
    return closed.unionByName(tail)
