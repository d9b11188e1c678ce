"""Sampled substrings of UTF-8 texts as hashes, whole Arrow batches at a time.

A substring of ``length`` bytes is sampled if the first or the last of its
``parts`` shorter substrings has the smallest hash among them (a closed
syncmer; all are with one part). That depends on the substring alone, so a text
has all the sampled substrings of each text in it, but only about two of
``parts`` substrings. Of any ``parts - 1`` in a row at least one is sampled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def least_length(length: int, parts: int) -> int:
    """Bytes from which a text surely has a sampled substring of ``length``."""
    return length + max(parts - 2, 0)


def _hashes(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    h = np.full(len(starts), length, np.uint64)
    for k in range(length):
        h = h * _BASE + data[starts + k] + np.uint64(1)
    for _ in range(2):
        h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(32))


def _smallest(h: np.ndarray, window: int) -> np.ndarray:
    """The smallest of each ``window`` values in a row."""
    n, done = len(h) - window + 1, 1
    while 2 * done <= window:
        h, done = np.minimum(h[:-done], h[done:]), 2 * done
    return np.minimum(h[:n], h[window - done:window - done + n])


def _bounds(column: pa.Array) -> np.ndarray:
    """Where each text of a binary column begins and the last one ends."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, and where each text begins; one number more than texts."""
    ends = _bounds(column)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]
    return data.astype(np.uint64), ends - ends[0]


BYTES_AT_ONCE = 1 << 20


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of batches with few bytes of text, or one text."""
    for batch in batches:
        sizes = np.diff(_bounds(batch.column(1)))
        begin = 0
        while begin < len(sizes):
            rows = max(1, int(np.searchsorted(np.cumsum(sizes[begin:]), BYTES_AT_ONCE, "right")))
            yield batch.slice(begin, rows)
            begin += rows


def _sampled(data: np.ndarray, bounds: np.ndarray, length: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of the sampled substrings."""
    n = len(data) - length + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    chosen = np.arange(length, length + n) <= bounds[text + 1]
    if parts > 1:
        h = _hashes(data, np.arange(n + parts - 1), length - parts + 1)
        least = _smallest(h, parts)
        chosen &= (least == h[:n]) | (least == h[parts - 1:])
    places = np.flatnonzero(chosen)
    return text[places], places


def sampled_hashes(df: DataFrame, key: str, text: str, lengths: dict[int, int]) -> DataFrame:
    """(key, hash): each row with the hashes of its text's sampled substrings, distinct. ``lengths``: {length: parts}."""
    wanted = sorted(lengths.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            data, bounds = _texts(batch.column(1))
            rows, hashes = [], []
            for length, parts in wanted:
                at, places = _sampled(data, bounds, length, parts)
                rows.append(at)
                hashes.append(_hashes(data, places, length))
            row, h = np.concatenate(rows), np.concatenate(hashes)
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row[new])), pa.array(h[new].view(np.int64))], names=[key, "hash"])

    out = df.select(key, F.col(text).cast("binary").alias("text"))
    return out.mapInArrow(run, f"{key} {out.schema[key].dataType.simpleString()}, hash bigint")


def sampled_substrings(df: DataFrame, text: str, length: int, parts: int) -> DataFrame:
    """(text, place, size, hash, whole): where in each text (in bytes) its sampled substrings are; one too short for a sample, or no longer than one, has itself (``whole``)."""
    least = max(length + 1, least_length(length, parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            data, bounds = _texts(batch.column(1))
            sizes = np.diff(bounds)
            at, places = _sampled(data, bounds, length, parts)
            long = sizes[at] >= least
            rows, begins = [at[long]], [places[long]]
            hashes = [_hashes(data, places[long], length)]
            for n in np.unique(sizes[sizes < least]):
                own = np.flatnonzero(sizes == n)
                rows.append(own)
                begins.append(bounds[own])
                hashes.append(_hashes(data, bounds[own], int(n)))
            row, begin = np.concatenate(rows), np.concatenate(begins)
            whole = sizes[row] < least
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array((begin - bounds[row]).astype(np.int32)), pa.array(np.where(whole, sizes[row], length).astype(np.int32)),
                 pa.array(np.concatenate(hashes).view(np.int64)), pa.array(whole)], names=[text, "place", "size", "hash", "whole"])

    out = df.select(text, F.col(text).cast("binary").alias("text"))
    return out.mapInArrow(run, f"{text} string, place int, size int, hash bigint, whole boolean")
