"""Best-fit packing of token sequences: bounded-space online best fit.

Each task reads its split once, tokenizes, cuts documents into pieces and
places every piece as it comes: in the open sequence with the least free
space that still holds it, else in a new one. At most ``open_bins`` sequences
are open; a bitset keyed by free space finds the best fit, and when there is
no room for one more the fullest closes. Nothing is shuffled, and a task holds
the free space of its open sequences and no tokens of placed pieces.

Defined cases: a null or empty text is its end token alone; repeated rows are
packed each; only documents longer than a sequence are cut, and only their
last piece may be shorter; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import chunks, encoder

CAPACITY = 2048
OPEN_BINS = 4096
END = b"\0\0\0\0"
BATCH_CHARS = 4 << 20
TASK_BITS = 33


class BestFit:
    """Open sequences by free space. Numbers count up from ``first``."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, first: int = 0):
        self.capacity, self.most, self.next = capacity, open_bins, first
        self.open, self.mask = 0, 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        at = self.bins[free].pop()
        if not self.bins[free]:
            self.mask &= ~(1 << free)
        self.open -= 1
        return at

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of a piece of 1 to ``capacity`` tokens."""
        fits = self.mask >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            at = self._take(free)
        else:
            free, at = self.capacity, self.next
            self.next += 1
        left = free - length
        if left:
            if self.open >= self.most:
                self._take((self.mask & -self.mask).bit_length() - 1)
            self.bins[left].append(at)
            self.mask |= 1 << left
            self.open += 1
        return at, self.capacity - free


PACKED = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids", pa.binary()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, open_bins: int = OPEN_BINS, specials: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids (little-endian unsigned 32-bit), sequence_id, offset.

    ``vocabulary`` is a file of the tokenizers library that all executors have; ``specials`` as for ``tokens.Encoder``.
    """
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = BestFit(capacity, open_bins, TaskContext.get().partitionId() << TASK_BITS)
        encode = encoder(vocabulary, specials).encode
        for batch in batches:
            rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            for group in chunks(rows, BATCH_CHARS, lambda r: len(r[1])):
                columns: list[list] = [[] for _ in PACKED.names]
                for (doc_id, _), data in zip(group, encode([t for _, t in group]), strict=True):
                    data += END
                    n = len(data) // 4
                    for piece, start in enumerate(range(0, n, capacity)):
                        length = min(capacity, n - start)
                        at, offset = bins.place(length)
                        for column, value in zip(columns, (doc_id, piece, start, length, data[4 * start : 4 * (start + length)], at, offset), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PACKED, strict=True)], schema=PACKED)

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return slim.mapInArrow(packed, "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long")


def placements(packed: DataFrame) -> DataFrame:
    """The pieces' places with a checksum instead of their ids."""
    return packed.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
