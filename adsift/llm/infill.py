"""Fill-in-middle transformation of texts by displacement scatter.

A text is cut into units (runs of ASCII letters, any other code point singly)
and split at two of them into prefix, middle and suffix, which are put in
another order behind markers. A batch of texts is one byte buffer:

* units and code points are marked by one scan of the buffer, with counts per
  block, so that the place of a unit and the number of code points before a
  byte are found without listing them;
* every segment moves as a whole, so the shift of its bytes changes only where
  a segment starts: these changes are a difference array, its cumulative sum
  gives every byte its output place, and one scatter builds all outputs;
* ``restore`` finds the markers in the outputs, makes the differences of the
  inverse shifts and gathers the texts back.

Buffers are worked through in slabs, so memory is a small multiple of the
longest text, or of ``BATCH_BYTES``. There is no shuffle; a lost task runs
again with the same result, as cuts come from the id alone.

Defined cases: a null or empty text is plain, has no units and an empty output;
texts that hold a marker are plain, so markers stand once in any other output;
very long texts are cut whole; rows with the same id are cut by the same
numbers, each on its own; a null id draws its numbers from an empty id; no rows
give no rows; other columns don't matter, whatever their names, and come along
in the struct ``doc`` if asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 1
PLAIN_FROM = 90     # of 100
SPM_BELOW = 20      # of 100
PLAIN, PSM, SPM = "plain", "psm", "spm"
BATCH_BYTES = 4 << 20
BLOCK = 4096
SLAB = 1 << 20


class Marks:
    """Marked bytes of a buffer, counted by blocks."""

    def __init__(self, mask: np.ndarray):
        self.mask = mask
        blocks = np.add.reduceat(mask, np.arange(0, len(mask), BLOCK), dtype=np.int64) if len(mask) else np.zeros(0, np.int64)
        self.before = np.concatenate([[0], np.cumsum(blocks)])

    def count(self, end: int) -> int:
        """Marks before byte ``end``."""
        block = end // BLOCK
        return int(self.before[block]) + int(np.count_nonzero(self.mask[block * BLOCK : end]))

    def place(self, k: int) -> int:
        """Byte of the k-th mark (from 0)."""
        block = int(np.searchsorted(self.before, k, side="right")) - 1
        inside = np.flatnonzero(self.mask[block * BLOCK : (block + 1) * BLOCK])
        return block * BLOCK + int(inside[k - int(self.before[block])])


def units(data: np.ndarray, starts: np.ndarray) -> tuple[Marks, Marks]:
    """(starts of units, starts of code points) of the texts that start at ``starts`` of a UTF-8 buffer."""
    letter = ((data | 0x20) - np.uint8(97)) < 26
    lead = (data & 0xC0) != 0x80
    first = lead.copy()
    first[1:] &= ~(letter[1:] & letter[:-1])
    first[starts[starts < len(data)]] = True
    return Marks(first), Marks(lead)


def found(data: np.ndarray, marker: bytes) -> np.ndarray:
    """Bytes at which the three-byte marker stands."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    a, b, c = marker
    return np.flatnonzero((data[1:-1] == b) & (data[:-2] == a) & (data[2:] == c))


def owner(starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of the markers at ``at`` that lie inside one text."""
    text = np.searchsorted(starts, at, side="right") - 1
    whole = at + 3 <= ends[text]
    return text[whole], at[whole]


def shifted(n: int, begins: np.ndarray, shifts: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(from, to, places): for bytes 0 to n, the place that each gets from the shift of its segment.

    ``begins`` is in order and starts at 0; where segments begin at the same byte the last one counts.
    """
    delta = np.diff(shifts, prepend=0)
    held = 0
    for low in range(0, n, SLAB):
        high = min(low + SLAB, n)
        i, j = np.searchsorted(begins, [low, high])
        step = np.zeros(high - low, np.int64)
        np.add.at(step, begins[i:j] - low, delta[i:j])
        step[0] += held
        shift = np.cumsum(step)
        held = int(shift[-1])
        yield low, high, shift + np.arange(low, high)


def _columns(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string array without nulls."""
    wide = pa.types.is_large_string(array.type)
    kind = np.int64 if wide else np.int32
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(array.buffers()[1], kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    held = array.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def runs(offsets: np.ndarray, most: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive texts of at most ``most`` bytes together, or one text."""
    i = 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, j
        i = j


def numbers(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """The four numbers that decide a text's cuts and form."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[8 * k : 8 * k + 8], 16) for k in range(4))


def split(doc_ids: list[int | None], data: np.ndarray, offsets: np.ndarray, seed: int = SEED):
    """(n, form, cuts, prefix_chars, middle_chars) of each text; cuts are (start of middle, of suffix) as bytes, None if plain."""
    starts, ends = offsets[:-1], offsets[1:]
    unit, point = units(data, starts)
    plain = np.zeros(len(doc_ids), bool)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        plain[owner(starts, ends, found(data, marker))[0]] = True
    for i, doc_id in enumerate(doc_ids):
        s, e = int(starts[i]), int(ends[i])
        first = unit.count(s)
        n = unit.count(e) - first
        h1, h2, h3, h4 = numbers(doc_id, seed)
        if n == 0 or plain[i] or h3 % 100 >= PLAIN_FROM:
            yield n, PLAIN, None, None, None
            continue
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = (unit.place(first + k) if k < n else e for k in (low, high))
        at = point.count(a)
        yield n, SPM if h4 % 100 < SPM_BELOW else PSM, (a, b), at - point.count(s), point.count(b) - at


def scatter(data: np.ndarray, offsets: np.ndarray, forms: list[str], cuts: list[tuple[int, int] | None]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the outputs of all texts."""
    moved = np.array([f != PLAIN for f in forms], bool)
    out_offsets = np.concatenate([[0], np.cumsum(np.diff(offsets) + 9 * moved)])
    out = np.empty(int(out_offsets[-1]), np.uint8)
    begins, shifts = [], []
    marked: dict[bytes, list[int]] = {PREFIX: [], SUFFIX: [], MIDDLE: []}
    for form, cut, s, e, o in zip(forms, cuts, offsets[:-1].tolist(), offsets[1:].tolist(), out_offsets.tolist(), strict=False):
        if form == PLAIN:
            begins.append(s)
            shifts.append(o - s)
            continue
        a, b = cut
        first, second = ((PREFIX, a - s), (SUFFIX, e - b)) if form == PSM else ((SUFFIX, e - b), (PREFIX, a - s))
        at = {first[0]: o, second[0]: o + 3 + first[1], MIDDLE: o + 6 + first[1] + second[1]}
        for marker, place in at.items():
            marked[marker].append(place)
        begins += (s, a, b)
        shifts += (at[PREFIX] + 3 - s, at[MIDDLE] + 3 - a, at[SUFFIX] + 3 - b)
    for low, high, places in shifted(len(data), np.array(begins, np.int64), np.array(shifts, np.int64)):
        out[places] = data[low:high]
    for marker, at in marked.items():
        for k, byte in enumerate(marker):
            out[np.array(at, np.int64) + k] = byte
    return out, out_offsets


def gather(data: np.ndarray, offsets: np.ndarray, forms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts that ``scatter`` put in order by their forms."""
    starts, ends = offsets[:-1], offsets[1:]
    moved = np.array([f != PLAIN for f in forms], bool)
    at = {}
    for marker in (PREFIX, SUFFIX, MIDDLE):
        text, place = owner(starts, ends, found(data, marker))
        text, place = text[moved[text]], place[moved[text]]
        if not np.array_equal(text, np.flatnonzero(moved)):
            raise ValueError(f"an output without {marker.decode()}, or with more than one")
        places = np.zeros(len(forms), np.int64)
        places[text] = place
        at[marker] = places.tolist()
    out_offsets = np.concatenate([[0], np.cumsum(np.diff(offsets) - 9 * moved)])
    out = np.empty(int(out_offsets[-1]), np.uint8)
    begins, shifts = [], []
    for i, (form, s, e, r) in enumerate(zip(forms, starts.tolist(), ends.tolist(), out_offsets.tolist(), strict=False)):
        if form == PLAIN:
            begins.append(r)
            shifts.append(s - r)
            continue
        p, u, m = at[PREFIX][i], at[SUFFIX][i], at[MIDDLE][i]
        if s != min(p, u) or m < max(p, u):
            raise ValueError("markers out of order")
        before, after = (u if form == PSM else m) - p - 3, (m if form == PSM else p) - u - 3
        middle = e - m - 3
        begins += (r, r + before, r + before + middle)
        shifts += (p + 3 - r, m + 3 - r - before, u + 3 - r - before - middle)
        if after != out_offsets[i + 1] - r - before - middle:
            raise ValueError("an output that is not of its form")
    for low, high, places in shifted(len(out), np.array(begins, np.int64), np.array(shifts, np.int64)):
        out[low:high] = data[places]
    return out, out_offsets


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, columns: tuple[str, ...] = ()) -> DataFrame:
    """One row per text: doc_id, n (units), form, prefix_chars, middle_chars, output, and struct doc of ``columns``."""
    carried = [F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc")] if columns else []
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *carried)

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _columns(batch.column(1))
            doc_ids = batch.column(0).to_pylist()
            for i, j in runs(offsets):
                part, bounds = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                ns, forms, cuts, prefix, middle = map(list, zip(*split(doc_ids[i:j], part, bounds, seed), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(ns, pa.int64()), pa.array(forms), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                     _strings(*scatter(part, bounds, forms, cuts)), *[c.slice(i, j - i) for c in batch.columns[2:]]],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", *(["doc"] if columns else [])])

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    if columns:
        schema += f", doc {slim.schema['doc'].dataType.simpleString()}"
    return slim.mapInArrow(moved, schema)


def restore(outputs: DataFrame, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """``outputs`` plus ``restored``: the texts, rebuilt from output and form alone. An output that is not of its form is an error."""
    names = [c for c in outputs.columns if c != "restored"]
    slim = outputs.select(*[F.col(f"`{c}`") for c in names])
    text, kind = names.index(output_col), names.index(form_col)

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _columns(batch.column(text))
            forms = batch.column(kind).to_pylist()
            for i, j in runs(offsets):
                part, bounds = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                back = _strings(*gather(part, bounds, forms[i:j]))
                yield pa.RecordBatch.from_arrays([*[c.slice(i, j - i) for c in batch.columns], back], names=[*names, "restored"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields)
    return slim.mapInArrow(moved, f"{schema}, restored string")
