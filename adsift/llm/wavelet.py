"""Token files as wavelet matrices, one compressed file per shard.

A shard holds the ids of consecutive documents in order of their ids. Its
wavelet matrix has one bit-plane per bit of an id, from the highest; each
plane is the bits of the sequence as the planes before it left it, zeros
first. With the count of ones before every block, a plane answers rank and
select, and the matrix gives the id at a place, the count of an id before a
place and the place of its k-th occurrence, from the file alone.

Documents are range-partitioned by id, and each task writes its shards: under
a name of its attempt, then moved to the shard's name, so a task that runs
again leaves the same files. The folder is in shared storage that pyarrow can
open (file, hdfs, s3, gs); Spark reads the files back.

Defined cases: a null or empty text is its end token alone; a null id comes
first; rows with the same id stand in a fixed order by content and place;
repeated rows are stored each; no rows give no file and no rows.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..plans.strategy import write_table
from ..session import scratch_dir
from .shared import FILE, ROW, with_row_key
from .tokens import chunks, encoder

MAGIC = b"WVMX0001"
BLOCK = 512  # bits for each stored count
SHARD_TOKENS = 4 << 20
END = b"\0\0\0\0"
BATCH_CHARS = 4 << 20


class Plane:
    """Bits with a count of ones before each block."""

    def __init__(self, packed: np.ndarray, counts: np.ndarray, n: int, zeros: int):
        self.packed, self.counts, self.n, self.zeros = packed, counts, n, zeros

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.packed, count=self.n).view(bool)

    def bit(self, i: int) -> int:
        return int(self.packed[i >> 3]) >> (7 - (i & 7)) & 1

    def rank1(self, i: int) -> int:
        """Ones among the first ``i`` bits."""
        block = i // BLOCK
        left = i - block * BLOCK
        return int(self.counts[block]) + int(np.unpackbits(self.packed[block * BLOCK // 8 : (i + 7) // 8], count=left).sum() if left else 0)

    def select(self, bit: int, k: int) -> int:
        """Place of the k-th (from 0) bit of this kind."""
        starts = self.counts if bit else np.arange(len(self.counts)) * BLOCK - self.counts
        block = int(np.searchsorted(starts, k, side="right")) - 1
        inside = np.unpackbits(self.packed[block * BLOCK // 8 : (block + 1) * BLOCK // 8], count=min(BLOCK, self.n - block * BLOCK))
        return block * BLOCK + int(np.flatnonzero(inside == bit)[k - int(starts[block])])


class WaveletMatrix:
    def __init__(self, planes: list[Plane], n: int):
        self.planes, self.n = planes, n

    @classmethod
    def build(cls, ids: np.ndarray, levels: int | None = None) -> WaveletMatrix:
        n = len(ids)
        levels = levels or max(1, int(ids.max()).bit_length() if n else 1)
        x = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        planes = []
        for k in reversed(range(levels)):
            ones = (x >> k & 1).astype(bool)
            packed = np.packbits(ones)
            blocks = np.zeros(-(-n // BLOCK) * BLOCK // 8, np.uint8)
            blocks[: len(packed)] = packed
            whole = np.bitwise_count(blocks).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.int64)
            counts = np.concatenate([[0], np.cumsum(whole)]).astype(np.uint32)
            zeros = n - int(counts[-1])
            planes.append(Plane(packed, counts, n, zeros))
            x = np.concatenate([x[~ones], x[ones]])
        return cls(planes, n)

    def decode(self) -> np.ndarray:
        """All ids: the planes undone from the last."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        x = np.zeros(self.n, kind)
        for k, plane in enumerate(reversed(self.planes)):
            ones, y = plane.bits(), np.empty(self.n, kind)
            y[~ones] = x[: plane.zeros]
            y[ones] = x[plane.zeros :] | kind(1 << k)
            x = y
        return x.astype(np.uint32)

    def access(self, i: int) -> int:
        value = 0
        for plane in self.planes:
            bit = plane.bit(i)
            value = value << 1 | bit
            i = plane.zeros + plane.rank1(i) if bit else i - plane.rank1(i)
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the token's occurrences before ``end`` stand after the last plane."""
        if token >> len(self.planes):
            return 0, 0
        low, high = 0, end
        for k, plane in enumerate(self.planes):
            a, b = plane.rank1(low), plane.rank1(high)
            low, high = (plane.zeros + a, plane.zeros + b) if token >> (len(self.planes) - 1 - k) & 1 else (low - a, high - b)
        return low, high

    def count(self, token: int, end: int | None = None) -> int:
        """Occurrences of the token before ``end``."""
        low, high = self._range(token, self.n if end is None else end)
        return high - low

    def find(self, token: int, k: int) -> int:
        """Place of the token's k-th occurrence (from 0)."""
        low, high = self._range(token, self.n)
        if not 0 <= k < high - low:
            raise IndexError(k)
        at = low + k
        for j, plane in enumerate(reversed(self.planes)):
            bit = token >> j & 1
            at = plane.select(bit, at - plane.zeros if bit else at)
        return at


def to_bytes(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, levels: int | None = None) -> bytes:
    """A shard's file: magic, length of the header, header, compressed sections."""
    matrix = WaveletMatrix.build(ids, levels)
    packer = zstandard.ZstdCompressor(level=1)
    parts = [json.dumps(doc_ids).encode(), np.asarray(lengths, "<i8").tobytes()]
    for plane in matrix.planes:
        parts += [plane.packed.tobytes(), plane.counts.astype("<u4").tobytes()]
    parts = [packer.compress(p) for p in parts]
    header = json.dumps({"n": matrix.n, "zeros": [p.zeros for p in matrix.planes], "sections": [len(p) for p in parts]}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *parts])


def from_bytes(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """(document ids, their token counts, matrix) of a shard's file."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a shard of token ids")
    at = len(MAGIC) + 4
    size = struct.unpack("<I", data[len(MAGIC) : at])[0]
    header = json.loads(data[at : at + size])
    at += size
    sections, unpacker = [], zstandard.ZstdDecompressor()
    for length in header["sections"]:
        sections.append(unpacker.decompress(data[at : at + length]))
        at += length
    planes = [Plane(np.frombuffer(sections[2 + 2 * k], np.uint8), np.frombuffer(sections[3 + 2 * k], "<u4").astype(np.int64), header["n"], zeros)
              for k, zeros in enumerate(header["zeros"])]
    return json.loads(sections[0]), np.frombuffer(sections[1], "<i8"), WaveletMatrix(planes, header["n"])


def store(uri: str):
    """(pyarrow file system, path) of a folder."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = uri[len("file:") :]
    return fs.FileSystem.from_uri("/" + uri.lstrip("/") if uri.startswith("/") else uri)


def save(uri: str, name: str, data: bytes) -> None:
    files, folder = store(uri)
    files.create_dir(folder, recursive=True)
    own = f"{folder}/_{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(own) as out:
        out.write(data)
    try:
        files.move(own, f"{folder}/{name}")
    except OSError:  # a store that doesn't replace: another attempt has left the same file
        files.delete_file(own)


SHARDS = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("name", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())])


def write_shards(docs: DataFrame, vocabulary: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 shard_tokens: int = SHARD_TOKENS, specials: bool = False) -> DataFrame:
    """Write the shards of all documents; one row per shard: part, shard, name, docs, tokens. ``specials`` as for ``tokens.Encoder``."""
    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encode = TaskContext.get().partitionId(), encoder(vocabulary, specials).encode
        doc_ids, held, size, shard = [], [], 0, 0

        def closed():
            name = f"shard-{part:06d}-{shard:06d}.wm"
            save(folder, name, to_bytes(doc_ids, [len(d) // 4 for d in held], np.frombuffer(b"".join(held), "<u4")))
            row = {"part": part, "shard": shard, "name": name, "docs": len(doc_ids), "tokens": size}
            return pa.RecordBatch.from_pylist([row], schema=SHARDS)

        for batch in batches:
            rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            for group in chunks(rows, BATCH_CHARS, lambda r: len(r[1])):
                for (doc_id, _), data in zip(group, encode([t for _, t in group]), strict=True):
                    doc_ids.append(doc_id)
                    held.append(data + END)
                    size += len(data) // 4 + 1
                    if size >= shard_tokens:
                        yield closed()
                        doc_ids, held, size, shard = [], [], 0, shard + 1
        if doc_ids:
            yield closed()

    keyed = with_row_key(docs, F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col(FILE), F.col(ROW)]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return write_table(ordered.mapInArrow(written, "part int, shard int, name string, docs long, tokens long"), "shards")


READ = pa.schema([("name", pa.string()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files: name (of its shard), doc_id, at (its start there), n_tokens, ids."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                doc_ids, lengths, matrix = from_bytes(content.as_py())
                data = matrix.decode().astype("<u4").tobytes()
                ends = np.cumsum(lengths)
                starts = ends - lengths
                cut = [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([path.rsplit("/", 1)[-1]] * len(cut)), pa.array(doc_ids, pa.int64()), pa.array(starts),
                                                  pa.array(lengths), pa.array(cut, pa.binary())], schema=READ)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.wm").load(folder).select("path", "content")
    return files.mapInArrow(read, "name string, doc_id long, at long, n_tokens long, ids binary")


def shard_starts(shards: DataFrame) -> DataFrame:
    """(file, before): the ids of all shards before each. One row per shard is ordered in one task."""
    before = W.orderBy("part", "shard").rowsBetween(W.unboundedPreceding, -1)
    return shards.select(F.col("name").alias("file"), F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before"))


def new_folder(spark: SparkSession) -> str:
    return scratch_dir(spark, f"tables/token-shards-{uuid.uuid4().hex}")


def digests(spark: SparkSession, shards: DataFrame, folder: str) -> DataFrame:
    """Per document, read from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    if shards.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    rows = read_shards(spark, folder).select("name", "doc_id", "at", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return rows.join(shard_starts(shards), F.col("name") == F.col("file")).select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
