"""Sharded WARC archives of web pages, the same bytes on every run.

``write``:

* Records stand in order of page id. Sizes are prefix-summed over a
  range-partitioned table without the payloads, so a record's ordinal and its
  shard depend on the rows alone and not on how a scan or a shuffle was split.
  The shards' first keys are at most ``MOST_SHARDS`` and go to the tasks.
* Of equal payloads the first record is the response, the others revisit it.
  The first one is the smallest ordinal per digest, taken in two steps over
  salted groups, so that a payload of a third of all rows is no hot group.
* Rows and what is known of the revisits among them are dealt out by shard and
  sorted, each revisit's line right before its row, so payloads are shuffled
  once and never joined.
* The task of a shard makes all headers and digests anew, compresses each
  record as a gzip member of its own and begins a new file when one has
  reached ``file_bytes`` compressed. A file is written under a temporary name
  and moved when complete; a task that runs again leaves the same files.
* The manifest, one row per file with its size and SHA-256, is committed last.
  An archive is what its manifest lists.

``read`` streams the files of the manifest and checks every digest, length and
file on the way; what doesn't agree is an error.

Both keep one record in memory. The folder is in shared storage that pyarrow
can open (file, hdfs, s3, gs).

Defined cases: a null payload is empty; a null id comes last and is the
response only if no equal payload has an id; rows with the same id stand in
order of a hash of address and payload, repeated rows are records of their own;
control characters and spaces of an address are percent-encoded, a null address
gives no header; payloads under ``least_bytes`` are always responses; very long
payloads make a file of their own size; no rows give an empty manifest and no
file; other columns don't matter, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..plans.strategy import write_table
from ..session import scratch_dir
from .shared import FILE, ROW, as_scan, with_row_key
from .wavelet import store

SHARD_BYTES = 32 << 20   # of payloads
FILE_BYTES = 16 << 20    # compressed
MOST_SHARDS = 1 << 16
RECORD_BYTES = 512       # counted for each record beside its payload
SALTS = 64
READ_BYTES = 32 << 10
BATCH_BYTES = 4 << 20
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
# Fixed texts of the format.
VERSION = b"WARC/1.1\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = pa.schema([("shard", pa.int32()), ("roll", pa.int32()), ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()),
                      ("sha256", pa.string()), ("first_ordinal", pa.int64())])
MANIFEST_DDL = "shard int, roll int, name string, records long, bytes long, sha256 string, first_ordinal long"


# --------------------------------------------------------------------------- records

def sha1(*parts: bytes) -> str:
    digest = hashlib.sha1()
    for p in parts:
        digest.update(p)
    return base64.b32encode(digest.digest()).decode()


def record_id(ordinal: int, page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{ordinal}:{page_id}'.encode()).digest()[:16], version=4)}>"


def address(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def pack(headers: dict[str, str | None], block: list[bytes], level: int = LEVEL) -> bytes:
    """A record as a gzip member."""
    headers |= {"WARC-Block-Digest": "sha1:" + sha1(*block), "Content-Length": str(sum(map(len, block)))}
    head = "".join(f"{k}: {v}\r\n" for k, v in headers.items() if v is not None).encode()
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return b"".join([*map(packer.compress, (VERSION, head, b"\r\n", *block, b"\r\n\r\n")), packer.flush()])


def page_record(ordinal: int, page_id: int | None, url: str | None, payload: bytes, first: tuple[int, int | None, str | None] | None, date: str) -> bytes:
    """The response, or the revisit of the record ``first`` (ordinal, id, address)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = {"WARC-Type": "response" if first is None else "revisit", "WARC-Record-ID": record_id(ordinal, page_id), "WARC-Date": date,
               "WARC-Target-URI": None if url is None else address(url), "Page-ID": None if page_id is None else str(page_id),
               "WARC-Payload-Digest": "sha1:" + sha1(payload), "Content-Type": "application/http;msgtype=response"}
    if first is None:
        return pack(headers, [http, payload])
    headers |= {"WARC-Profile": REVISIT, "WARC-Refers-To": record_id(first[0], first[1]),
                "WARC-Refers-To-Target-URI": None if first[2] is None else address(first[2]),
                "Refers-To-Page-ID": None if first[1] is None else str(first[1])}
    return pack(headers, [http])


def info_record(name: str, date: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    made = uuid.UUID(bytes=hashlib.sha256(name.encode()).digest()[:16], version=4)
    return pack({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{made}>", "WARC-Date": date, "WARC-Filename": name,
                 "Content-Type": "application/warc-fields"}, [block])


class Roll:
    """One file at a time under a temporary name, moved to its own name when it is complete."""

    def __init__(self, folder: str, shard: int, file_bytes: int, date: str):
        self.files, self.path = store(folder)
        self.files.create_dir(self.path, recursive=True)
        self.shard, self.file_bytes, self.date, self.roll, self.out = shard, file_bytes, date, 0, None

    def add(self, ordinal: int, data: bytes) -> Iterator[dict]:
        """Append a record; the manifest row of the file that this one ends."""
        if self.out is None:
            self.name = f"pages-{self.shard:06d}-{self.roll:06d}.warc.gz"
            self.own = f"{self.path}/_{self.name}.{uuid.uuid4().hex}"
            self.out, self.digest, self.bytes, self.records, self.first = self.files.open_output_stream(self.own), hashlib.sha256(), 0, 0, ordinal
            self._put(info_record(self.name, self.date))
        self._put(data)
        self.records += 1
        if self.bytes >= self.file_bytes:
            yield from self.close()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.digest.update(data)
        self.bytes += len(data)

    def close(self) -> Iterator[dict]:
        if self.out is None:
            return
        self.out.close()
        self.out = None
        try:
            self.files.move(self.own, f"{self.path}/{self.name}")
        except OSError:  # a store that doesn't replace: another attempt has left the same file
            self.files.delete_file(self.own)
        self.roll += 1
        yield {"shard": self.shard, "roll": self.roll - 1, "name": self.name, "records": self.records, "bytes": self.bytes,
               "sha256": self.digest.hexdigest(), "first_ordinal": self.first}


# --------------------------------------------------------------------------- order, shards, revisits

ORDER = ("no_id", "page_id", "tie", FILE, ROW)


def _keys(pages: DataFrame, id_col: str, url_col: str, payload_col: str, *more: Column) -> DataFrame:
    page_id, payload = F.col(id_col).cast("long"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    return with_row_key(pages, page_id.alias("page_id"), page_id.isNull().alias("no_id"), F.col(url_col).alias("url"),
                        F.xxhash64(F.col(url_col), payload).alias("tie"), *more, payload.alias("payload"))


def placed(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    """Each row without its payload: key columns, url, sha, size, ordinal and ``before``, the bytes of all rows before it."""
    slim = _keys(pages, id_col, url_col, payload_col).select(*ORDER, "url", F.sha2("payload", 256).alias("sha"), F.length("payload").cast("long").alias("size"))
    # Written first, as range partitioning reads its input twice; and written with the partition numbers, so that all uses see the same ones.
    ranged = write_table(write_table(slim, "warc-sizes").repartitionByRange(*ORDER).withColumn("part", F.spark_partition_id()), "warc-ranged")
    sums = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("size") + RECORD_BYTES).alias("bytes"))
    ahead = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)    # one row per partition
    starts = sums.select(F.col("part").alias("p"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("n0"),
                         F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("bytes0"))
    inside = W.partitionBy("part").orderBy(*ORDER).rowsBetween(W.unboundedPreceding, -1)
    counted = (ranged.withColumn("i", F.count(F.lit(1)).over(inside))
               .withColumn("b", F.coalesce(F.sum(F.col("size") + RECORD_BYTES).over(inside), F.lit(0))))
    return counted.join(starts, F.col("part") == F.col("p")).select(
        *ORDER, "url", "sha", "size", (F.col("n0") + F.col("i")).alias("ordinal"), (F.col("bytes0") + F.col("b")).alias("before"))


def revisits(rows: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The rows whose payload an earlier row has, with that row as ``first`` (ordinal, page_id, url)."""
    salted = rows.where(F.col("size") >= least_bytes).withColumn("salt", F.pmod("ordinal", F.lit(SALTS)))
    first = F.min(F.struct("ordinal", "page_id", "url")).alias("first")
    parts = write_table(salted.groupBy("sha", "salt").agg(first, F.count(F.lit(1)).alias("n")), "warc-digests")
    whole = (parts.groupBy("sha").agg(F.min("first").alias("first"), F.sum("n").alias("n")).where("n > 1")
             .select(F.col("sha").alias("s"), "first"))
    spread = parts.select("sha", "salt").join(whole, F.col("sha") == F.col("s")).select(F.col("s"), F.col("salt").alias("t"), "first")
    return (salted.join(spread, (F.col("sha") == F.col("s")) & (F.col("salt") == F.col("t")))
            .where(F.col("ordinal") > F.col("first.ordinal")).drop("s", "t", "salt"))


# --------------------------------------------------------------------------- write

def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0,
          shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, date: str = DATE) -> DataFrame:
    """Write all pages to WARC files in ``folder``; the manifest: shard, roll, name, records, bytes, sha256, first_ordinal."""
    spark = pages.sparkSession
    pages = as_scan(pages)  # read twice: rows must have the same places
    rows = write_table(placed(pages, id_col, url_col, payload_col), "warc-placed")
    end = rows.agg(F.max(F.col("before") + F.col("size") + RECORD_BYTES)).collect()[0][0] or 0
    step = max(shard_bytes, -(-end // MOST_SHARDS), 1)
    shard = F.floor(F.col("before") / step).cast("int")
    # At most MOST_SHARDS + 1 rows: each shard's first key and ordinal.
    found = rows.groupBy(shard.alias("shard")).agg(F.min(F.struct("ordinal", *ORDER)).alias("k")).collect()
    bounds = sorted((tuple(x or 0 if c == "page_id" else x for c, x in zip(ORDER, r["k"][1:], strict=True)), r["k"]["ordinal"]) for r in found)
    firsts, ordinals = [b[0] for b in bounds], [b[1] for b in bounds]

    @F.pandas_udf("int")
    def number(no_id: pd.Series, page_id: pd.Series, tie: pd.Series, file: pd.Series, row: pd.Series) -> pd.Series:
        # Python numbers, as a long id does not fit a float.
        keys = zip(no_id.tolist(), page_id.tolist(), tie.tolist(), file.tolist(), row.tolist(), strict=True)
        return pd.Series([bisect_right(firsts, k) - 1 for k in keys], dtype="int32")

    def dealt(df: DataFrame) -> DataFrame:
        return df.withColumn("shard", number("no_id", F.coalesce("page_id", F.lit(0)), "tie", FILE, ROW))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, at, first = None, 0, None
        for batch in batches:
            done = []
            for k in range(batch.num_rows):
                here, page_id, url, payload, told = (c[k].as_py() for c in batch.columns)
                if roll is None or roll.shard != here:
                    if roll is not None:
                        done += roll.close()
                    roll, at, first = Roll(folder, here, file_bytes, date), ordinals[here], None
                if told is not None:
                    first = (told["ordinal"], told["page_id"], told["url"])
                    continue
                done += roll.add(at, page_record(at, page_id, url, payload, first, date))
                at, first = at + 1, None
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=MANIFEST)
        if roll is not None and (done := list(roll.close())):
            yield pa.RecordBatch.from_pylist(done, schema=MANIFEST)

    told = "struct<ordinal:bigint,page_id:bigint,url:string>"
    full = dealt(_keys(pages, id_col, url_col, payload_col)).select(
        "shard", *ORDER, F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast(told).alias("first"))
    known = dealt(revisits(rows, least_bytes)).select(
        "shard", *ORDER, F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"),
        F.col("first").cast(told).alias("first"))
    ordered = (full.unionByName(known).repartitionById(max(len(bounds), 1), "shard")
               .sortWithinPartitions("shard", *ORDER, "kind").select("shard", "page_id", "url", "payload", "first"))
    ordered.mapInArrow(written, MANIFEST_DDL).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)



# --------------------------------------------------------------------------- read

def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file of a complete archive."""
    return spark.read.schema(MANIFEST_DDL).parquet(f"{folder}/manifest")


def members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one by one."""
    unpacker, parts = zlib.decompressobj(31), []
    while data := stream.read(READ_BYTES):
        while data:
            parts.append(unpacker.decompress(data))
            if not unpacker.eof:
                break
            yield b"".join(parts)
            data, unpacker, parts = unpacker.unused_data, zlib.decompressobj(31), []
    if parts:
        raise ValueError("a record that is cut off")


class Hashed:
    """A stream whose bytes are counted and hashed as they are read."""

    def __init__(self, stream):
        self.stream, self.digest, self.bytes = stream, hashlib.sha256(), 0

    def read(self, n: int) -> bytes:
        data = self.stream.read(n)
        self.digest.update(data)
        self.bytes += len(data)
        return data


def _fields(lines: bytes) -> dict[str, str]:
    return {k: v for k, _, v in (line.partition(": ") for line in lines.decode().split("\r\n"))}


def parse(record: bytes) -> dict | None:
    """What a page's record holds, checked against its headers; None for another record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    if not head.startswith(VERSION):
        raise ValueError("not a WARC record")
    headers = _fields(head[len(VERSION) :])
    block = rest[: int(headers["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n" or "sha1:" + sha1(block) != headers["WARC-Block-Digest"]:
        raise ValueError(f"a damaged record {headers['WARC-Record-ID']}")
    kind = headers["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    length, digest = int(_fields(http)["Content-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or sha1(payload) != digest):
        raise ValueError(f"a payload that is not that of {headers['WARC-Record-ID']}")
    page_id, first = headers.get("Page-ID"), headers.get("Refers-To-Page-ID")
    return {"page_id": None if page_id is None else int(page_id), "url": headers.get("WARC-Target-URI"), "record_id": headers["WARC-Record-ID"],
            "record_type": kind, "payload_bytes": length, "payload_digest": digest, "refers_to": None if first is None else int(first),
            "refers_to_id": headers.get("WARC-Refers-To"), "payload": payload if kind == "response" else None}


RECORDS = pa.schema([("name", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("refers_to_id", pa.string()),
                     ("payload", pa.binary())])
RECORDS_DDL = ("name string, page_id long, url string, record_id string, record_type string, payload_bytes long, payload_digest string, "
               "refers_to long, refers_to_id string, payload binary")


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """One row per page of the archive: name (of its file), page_id, url, record_id, record_type, payload_bytes, payload_digest,
    refers_to (page id), refers_to_id, payload (null for revisits, and for all without ``payloads``)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = store(folder)
        for batch in batches:
            for name, size, sha256 in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                held, out = 0, []
                with files.open_input_stream(f"{path}/{name}", compression=None) as raw:
                    stream = Hashed(raw)
                    for record in members(stream):
                        row = parse(record)
                        if row is None:
                            continue
                        held += len(record)
                        out.append(row | {"name": name} | ({} if payloads else {"payload": None}))
                        if held >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(out, schema=RECORDS)
                            held, out = 0, []
                if stream.bytes != size or stream.digest.hexdigest() != sha256:
                    raise ValueError(f"{name} is not the file of the manifest")
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=RECORDS)

    files = manifest(spark, folder).select("name", "bytes", "sha256")
    tasks = min(max(files.count(), 1), 4 * spark.sparkContext.defaultParallelism)
    return files.repartition(tasks).mapInArrow(rows, RECORDS_DDL)


def new_folder(spark: SparkSession) -> str:
    return scratch_dir(spark, f"tables/warc-{uuid.uuid4().hex}")
