"""Deterministic sharded WARC archives.

Writer: records are range-sorted by id into shards whose bounds come from an
exact histogram of payload bytes over the ids (not from sampling), so equal
input gives equal files. Inside a shard, records are written in id order as
gzip members of their own; a file is closed as soon as its compressed size
reaches ``roll_bytes``. Headers and digests are regenerated from the payload.
Every file is written under a temporary name and renamed; then a manifest (one
row per file) is written, and readers open only files of the manifest, so a
repeated attempt is harmless and an unfinished archive is not read.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the
largest id is a ``response``; the others are ``revisit`` records that name it.

A payload is held whole while its record is written, so a task's memory grows with its
longest page only.

Defined cases: a null payload is empty; rows with a null id are spread over the
shards by payload, never referred to, and revisit the largest id of their group if
there is one; rows that share an id and a payload are all responses; extra columns are
ignored; an empty table gives an archive without files.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinstar.llm.files import NewFile, open_file

#: Bins per histogram; the driver holds at most this many sums at once.
BINS = 16_384
#: Payload bytes of a shard, and compressed bytes at which a file of it is closed. The number of
#: shards follows the table; the driver holds an id for each.
SHARD_BYTES, ROLL_BYTES = 16 << 20, 1 << 20
MANIFEST = "manifest.parquet"
_MANIFEST_SCHEMA = "file string, shard int, part int, records long, bytes long, sha256 string"
_RECORDS = ("id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
            "target_uri string, payload binary")


def page_records(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """(id, url, payload, digest) of the rows to be archived."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    return pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha1("payload"))


def revisits(records: DataFrame, min_bytes: int) -> DataFrame:
    """(id, digest, refers_to) of the records that repeat another one's payload; no payload moves."""
    long = records.where(F.octet_length("payload") >= min_bytes).select("id", "digest")
    groups = (long.groupBy("digest").agg(F.max("id").alias("refers_to"), F.count("*").alias("n"))
              .where("n > 1 and refers_to is not null").select("digest", "refers_to"))
    return long.join(groups, "digest").where(~F.col("id").eqNullSafe(F.col("refers_to"))).select(
        "id", "digest", "refers_to").distinct()


def _slot(edges: list[int]):
    """Number of edges <= id, as a column function (null ids count as the smallest)."""
    held = np.array(edges, dtype=np.int64)

    @F.pandas_udf("int")
    def slot(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        return pd.Series(np.where(known, np.searchsorted(held, ids.where(known, 0).astype("int64"), side="right"), 0), dtype="int32")
    return slot


def shard_bounds(records: DataFrame, shard_bytes: int = SHARD_BYTES) -> list[int]:
    """Smallest id of every shard but the first, from exact byte counts.

    The id range is cut into at most BINS bins; bins that alone outweigh a shard
    are cut again, all in one pass a level, until they fit or hold a single id.
    """
    sized = records.where("id is not null").select("id", F.octet_length("payload").cast("long").alias("bytes"))
    low, high = sized.agg(F.min("id"), F.max("id")).first()
    if low is None:
        return []
    final: dict[int, int] = {}  # first id of a bin -> its bytes
    heavy = [(low, high)]
    while heavy:
        ends: dict[int, int | None] = {}  # first id of a bin -> last one; None between heavy bins
        gaps = []
        for lo, hi in heavy:
            width = max(1, -(-(hi - lo + 1) // max(2, BINS // len(heavy))))
            ends |= {a: min(hi, a + width - 1) for a in range(lo, hi + 1, width)}
            gaps.append(hi + 1)
        for gap in gaps:
            ends.setdefault(gap, None)
        firsts = sorted(ends)
        sums = (sized.where(F.col("id").between(heavy[0][0], heavy[-1][1])).groupBy(_slot(firsts)("id").alias("bin"))
                .agg(F.sum("bytes")).collect())
        heavy = []
        for k, weight in sorted(map(tuple, sums)):
            first = firsts[k - 1]
            if ends[first] is not None:
                if weight > shard_bytes and ends[first] > first:
                    heavy.append((first, ends[first]))
                else:
                    final[first] = weight
    bounds, held = [], 0
    for first in sorted(final):
        if held and held + final[first] > shard_bytes:
            bounds.append(first)
            held = 0
        held += final[first]
    return bounds


def _member(header: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in header)
    raw = b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)  # a gzip member; zlib writes no time into it
    return packer.compress(raw) + packer.flush()


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(key, url, payload: bytes, refers, collection: str, date: str, level: int) -> bytes:
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if refers is not None else http + payload
    name = "none" if key is None else str(key)
    header = [("WARC-Type", "response" if refers is None else "revisit"),
              ("WARC-Record-ID", f"<urn:{collection}:page:{name}>"),
              ("WARC-Date", date),
              ("WARC-Target-URI", "".join(c for c in url or "" if c > " " and c != "\x7f")),
              ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Block-Digest", _sha1(block)), ("WARC-Payload-Digest", _sha1(payload))]
    if refers is not None:
        header += [("WARC-Refers-To", f"<urn:{collection}:page:{refers}>"),
                   ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return _member([*header, ("Content-Length", str(len(block)))], block, level)


def write_archive(records: DataFrame, folder: str, min_bytes: int = 1000, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES,
                  collection: str = "kinstar", date: str = "2026-01-01T00:00:00Z", level: int = 3) -> DataFrame:
    """Write the rows of :func:`page_records` below ``folder``; returns the manifest.

    Payloads are shuffled once, to their shards. What a record refers to is sent
    to the same place as a row of its own, which sorts before the record.
    """
    spark = records.sparkSession
    bounds = shard_bounds(records, shard_bytes)
    def write(batches):
        current, number, part, count, size, digest = None, None, 0, 0, 0, None
        done = []
        known = None  # (id, digest, refers_to) of the last mark

        def close():
            name = f"shard-{number:06d}-{part:05d}.warc.gz"
            current.commit(name)
            done.append((name, number, part, count, size, digest.hexdigest()))

        for batch in batches:
            for n, key, url, payload, sha1, refers in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if refers is not None:
                    known = (key, sha1, refers)
                    continue
                refers = known[2] if known is not None and known[:2] == (key, sha1) else None
                if current is not None and n != number:
                    close()
                    current, part = None, 0
                if current is None:
                    number, current, count, size, digest = n, NewFile(folder), 0, 0, hashlib.sha256()
                member = _record(key, url, payload, refers, collection, date, level)
                current.write(member)
                digest.update(member)
                count, size = count + 1, size + len(member)
                if size >= roll_bytes:
                    close()
                    current, part = None, part + 1
                    number = n
        if current is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], kind) for i, kind in enumerate(
                (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()))],
            names=["file", "shard", "part", "records", "bytes", "sha256"])

    # null ids have no place in the range: they are spread over the shards by their payload
    shards = len(bounds) + 1
    shard = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")).otherwise(
        _slot(bounds)("id")).alias("shard")
    none = F.lit(None)
    rows = records.select(shard, "id", "url", "payload", "digest", none.cast("long").alias("refers_to")).unionByName(
        revisits(records, min_bytes).select(shard, "id", none.cast("string").alias("url"),
                                            none.cast("binary").alias("payload"), "digest", "refers_to"))
    manifest = (rows.repartitionById(shards, F.col("shard"))
                .sortWithinPartitions("shard", "id", "digest", F.col("refers_to").asc_nulls_last(), "url")
                .mapInArrow(write, _MANIFEST_SCHEMA))
    # Spark's committer writes the manifest under temporary names, too, and last
    manifest.write.parquet(f"{folder}/{MANIFEST}")
    return spark.read.schema(_MANIFEST_SCHEMA).parquet(f"{folder}/{MANIFEST}")


class _Members(io.RawIOBase):
    """The decompressed bytes of concatenated gzip members."""

    def __init__(self, stream):
        self.stream, self.unpacker, self.left = stream, zlib.decompressobj(31), b""

    def readable(self):
        return True

    def readinto(self, buffer):
        while True:
            if self.unpacker.eof:
                self.left = self.unpacker.unused_data
                self.unpacker = zlib.decompressobj(31)
            data = self.left or self.stream.read(1 << 16)
            if not data:
                return 0
            out = self.unpacker.decompress(data, len(buffer))
            self.left = self.unpacker.unconsumed_tail
            if out:
                buffer[:len(out)] = out
                return len(out)


def records_of(stream):
    """(header dict, block) of every record of one WARC file."""
    reader = io.BufferedReader(_Members(stream), 1 << 18)
    while line := reader.readline():
        if line != b"WARC/1.1\r\n":
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        header = {}
        while (line := reader.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(": ")
            header[name] = value[:-2]
        block = reader.read(int(header["Content-Length"]))
        if len(block) != int(header["Content-Length"]) or reader.read(4) != b"\r\n\r\n":
            raise ValueError("truncated WARC record")
        yield header, block


def read_archive(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the files in the manifest; digests are checked while reading."""
    schema = _RECORDS if with_payload else _RECORDS.removesuffix(", payload binary")

    def number(uri: str):
        tail = uri.rpartition(":")[2].rstrip(">")
        return None if tail == "none" else int(tail)

    def rows(name: str):
        with open_file(folder, name) as stream:
            for header, block in records_of(stream):
                if _sha1(block) != header["WARC-Block-Digest"]:
                    raise ValueError(f"block digest of {header['WARC-Record-ID']} in {name} does not match")
                http, _, payload = block.partition(b"\r\n\r\n")
                kind, refers = header["WARC-Type"], header.get("WARC-Refers-To")
                if kind == "response" and _sha1(payload) != header["WARC-Payload-Digest"]:
                    raise ValueError(f"payload digest of {header['WARC-Record-ID']} in {name} does not match")
                length = int(http.rpartition(b"Content-Length: ")[2])
                digest = base64.b32decode(header["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                yield (number(header["WARC-Record-ID"]), length, digest, kind, number(refers) if refers else None,
                       header["WARC-Target-URI"], payload if kind == "response" else None)[:7 if with_payload else 6]

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()][:7 if with_payload else 6]
    names = [x.split()[0] for x in schema.split(", ")]

    def read(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                held, size = [], 0
                for row in rows(name):
                    held.append(row)
                    size += 200 + (len(row[6] or b"") if with_payload else 0)
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)

    files = spark.read.schema(_MANIFEST_SCHEMA).parquet(f"{folder}/{MANIFEST}").select("file")
    return files.repartition(max(1, files.count())).mapInArrow(read, schema)
