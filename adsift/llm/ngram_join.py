"""N-gram Jaccard join by MinHash banding, verified on full n-gram sets.

Texts are sets of hashed five-word shingles. Texts with the same set make one
set row. Set rows meet in buckets of equal band hashes (bands and rows chosen
for the target recall at the threshold); each member of a bucket hangs under
the bucket's smallest, and the components of these stars hold every pair that
shares a band. All pairs inside a component are then verified on the full
sets: large components are split into blocks of bounded members and shingles,
one task unit for each pair of blocks. A unit counts its links and gives a
spanning star of its linked sets, so neither the pairs of a group nor a whole
group ever stand in one place. Links across units are joined by components.

Results: a document's class is the component of verified links it is in, its
number of links the documents that are as similar as the threshold.

Defined cases: words are runs of letters, marks and digits, lower-cased; a
text of one to four words is one shingle; a text without words has no
shingle, no class and no links; null counts as empty; repeated rows and other
texts with the same set are linked; a null id is never the class id if a
member has one; no rows give no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.strategy import fits_broadcast, write_table
from .components import components
from .shared import FILE, ROW, as_scan, with_row_key

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
MOST_HASHES = 128
BLOCK_MEMBERS = 1024
BLOCK_SHINGLES = 2 << 20
TEXT_STEP = 1 << 20
SPARSE = 32
PAIRS_HELD = 2 << 20

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows whose bands reach the recall at the threshold within ``most`` hashes."""
    best = None
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows > most:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError("no banding reaches the recall within that many hashes")
    return best


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a fixed bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", BASE), ("down", BASE_INVERSE)):
                run = np.full(size, base, np.uint64)
                run[0] = 1
                setattr(self, name, np.cumprod(run, dtype=np.uint64))
        return self.up, self.down


POWERS = Powers()


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted different hashes of the word n-grams of a text whose words are separated by single spaces."""
    if not text:
        return np.zeros(0, np.uint64)
    data = np.frombuffer(text, np.uint8)
    gaps = np.flatnonzero(data == 32)
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(data)]])
    last = max(len(starts) - words, 0) + 1
    ends = ends[len(ends) - last :]
    starts = starts[:last]
    out, at = [], 0
    while at < last:  # a long text goes in steps that overlap by a shingle
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + TEXT_STEP)))
        low, high = int(starts[at]), int(ends[min(to, last) - 1])
        up, down = POWERS.upto(high - low + 1)
        run = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=run[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out.append(mixed((run[e] - run[s]) * down[s]))
        at = to
    return np.unique(np.concatenate(out))


def band_hashes(found: np.ndarray, bands: int, rows: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        np.minimum(least, (found[at : at + 2048, None] * a + b).min(axis=0), out=least)
    weights = np.arange(1, 2 * rows, 2, dtype=np.uint64) * BASE
    return mixed((mixed(least).reshape(bands, rows) * weights).sum(axis=1, dtype=np.uint64)).view(np.int64)


def coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) * BASE)
    return x[:n] | np.uint64(1), x[n:]


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", " "))


SIGNED = pa.schema([("doc_id", pa.int64()), (FILE, pa.string()), (ROW, pa.int64()), ("set_id", pa.string()), ("n", pa.int64()),
                    ("bands", pa.list_(pa.int64()))])


def sign(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    """Per document: doc_id, its place, set_id (a digest of its shingles; null: none), n (shingles), bands."""
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = coefficients(bands * rows)
        for batch in batches:
            ids, sizes, hashes = [], [], []
            for text in batch.column(3):
                found = shingles(text.as_buffer().to_pybytes(), words)
                ids.append(hashlib.blake2b(found.tobytes(), digest_size=16).hexdigest() if len(found) else None)
                sizes.append(len(found))
                hashes.append(band_hashes(found, bands, rows, a, b) if len(found) else np.zeros(0, np.int64))
            flat = pa.array(np.concatenate(hashes) if hashes else np.zeros(0, np.int64), pa.int64())
            ends = pa.array(np.concatenate([[0], np.cumsum([len(h) for h in hashes])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(ids, pa.string()),
                                              pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(ends, flat)], schema=SIGNED)

    keyed = with_row_key(docs, F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).cast("binary").alias("text"))
    return keyed.select("doc_id", FILE, ROW, "text").mapInArrow(
        signed, f"doc_id long, {FILE} string, {ROW} long, set_id string, n long, bands array<long>")


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of the sizes of all intersections.

    Shingles held by the same members count as one with a weight. Those that
    few members have, or few lack, are counted through their pairs; the rest
    by a product of matrices.
    """
    m = len(sets)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    held = np.diff(np.concatenate([first, [len(flat)]]))
    codes = mixed(np.arange(1, m + 1, dtype=np.uint64) * BASE)
    pattern = np.add.reduceat(codes[owner], first)
    several = held > 1
    first, held, pattern = first[several], held[several], pattern[several]
    common = np.zeros((m, m), np.float64)
    if not len(first):
        return common
    _, at, weight = np.unique(pattern, return_index=True, return_counts=True)
    first, held = first[at], held[at]
    few, lacking = held <= SPARSE, (m - held <= SPARSE) & (held > SPARSE)
    # A pair holds a shingle that few lack unless one of the two lacks it: 1 - a - b + ab.
    everywhere, alone = 0, np.zeros(m)
    pairs, worth, waiting = [], [], 0

    def count():
        nonlocal common, waiting
        if pairs:
            common += np.bincount(np.concatenate(pairs), np.concatenate(worth), m * m).reshape(m, m)
        pairs.clear(), worth.clear()
        waiting = 0

    for k in np.flatnonzero(few | lacking):
        own = owner[first[k] : first[k] + held[k]]
        if lacking[k]:
            lacks = np.ones(m, bool)
            lacks[own] = False
            own = np.flatnonzero(lacks)
            everywhere += weight[k]
            alone[own] += weight[k]
        pairs.append((own[:, None] * m + own).ravel())
        worth.append(np.full(len(own) ** 2, weight[k], np.float64))
        waiting += len(own) ** 2
        if waiting > PAIRS_HELD:
            count()
    count()
    common += everywhere - alone[:, None] - alone
    rest = np.flatnonzero(~few & ~lacking)
    for step in range(0, len(rest), 4096):
        part = rest[step : step + 4096]
        has = np.zeros((m, len(part)), np.float32)
        for c, k in enumerate(part):
            has[owner[first[k] : first[k] + held[k]], c] = 1
        common += (has * weight[part].astype(np.float32)) @ has.T
    return common


def linked(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix of the pairs of different sets that are similar enough."""
    sizes = np.array([len(s) for s in sets], np.float64)
    common = common_counts(sets)
    near = common * (1 + threshold) >= threshold * (sizes[:, None] + sizes) - 1e-6
    np.fill_diagonal(near, False)
    return near


def smallest_reached(near: np.ndarray, names: list[str]) -> list[str]:
    """Each member's smallest name among all it reaches."""
    root: list[str | None] = [None] * len(names)
    for i in sorted(range(len(names)), key=names.__getitem__):
        front = np.array([i])
        if root[i] is not None:
            continue
        root[i] = names[i]
        while len(front):
            reached = near[front].any(axis=0)
            front = np.array([j for j in np.flatnonzero(reached) if root[j] is None], dtype=np.int64)
            for j in front:
                root[j] = names[i]
    return root


UNIT = pa.schema([("set_id", pa.string()), ("root", pa.string()), ("links", pa.int64()), ("blocks", pa.int32())])


def verify(rows: DataFrame, words: int, threshold: float) -> DataFrame:
    """Rows in order of (comp, a, b), one run for each unit: set_id, block, blocks, copies, text -> set_id, root, links, blocks."""
    def unit(key, members):
        sets = [shingles(m[4], words) for m in members]
        near = linked(sets, threshold)
        if key[1] != key[2]:  # pairs within a block belong to the block's own unit
            block = np.array([m[1] for m in members])
            near &= block[:, None] != block
        links = near @ np.array([m[3] for m in members], np.float64)
        roots = smallest_reached(near, [m[0] for m in members])
        return [(m[0], r, int(n), m[2]) for m, r, n in zip(members, roots, links, strict=True) if n]

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, out = None, [], []

        def full():
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), UNIT, strict=True)], schema=UNIT)
            out.clear()
            return batch

        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if row[:3] != key:
                    out += unit(key, members) if len(members) > 1 else []
                    key, members = row[:3], []
                    if len(out) > 4096:
                        yield full()
                members.append(row[3:])
        out += unit(key, members) if len(members) > 1 else []
        if out:
            yield full()

    return rows.mapInArrow(verified, "set_id string, root string, links long, blocks int")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: float = THRESHOLD,
         recall: float = RECALL, most_hashes: int = MOST_HASHES, block_members: int = BLOCK_MEMBERS,
         block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per document: its place, doc_id, class_id (smallest id of its class), n_links, kept (one of each class)."""
    docs = as_scan(docs)
    bands, rows = choose_bands(threshold, recall, most_hashes)
    signed = write_table(sign(docs, id_col, text_col, words, bands, rows), "signed")
    # Rows are compared by (has no id, id, place), the smallest stands for a set and later for its class.
    who = F.struct(F.col("doc_id").isNull().alias("x"), F.col("doc_id").alias("doc_id"), F.col(FILE).alias("f"), F.col(ROW).alias("r"))
    sets = write_table(signed.where("set_id is not null").groupBy("set_id").agg(
        F.min(who).alias("who"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")), "sets")

    banded = sets.select("set_id", F.posexplode("bands").alias("band", "hash"))
    buckets = banded.groupBy(F.col("band").alias("b"), F.col("hash").alias("h")).agg(F.min("set_id").alias("head"), F.count(F.lit(1)).alias("held")).where("held > 1")
    stars = banded.join(buckets, (F.col("band") == F.col("b")) & (F.col("hash") == F.col("h"))).select(F.col("set_id").alias("u"), F.col("head").alias("v"))
    found = components(stars)

    members = sets.join(found, F.col("set_id") == F.col("node")).select("set_id", "who", "copies", "n", F.col("root").alias("comp"))
    weighed = members.groupBy(F.col("comp").alias("c")).agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("all"))
    blocks = F.greatest(F.ceil(F.col("m") / block_members), F.ceil(F.col("all") / block_shingles)).cast("int")
    # Written, as AQE splits a hot key only of a join that stands right on its shuffles; so are the heads below.
    split = write_table(weighed.select("c", blocks.alias("blocks")), "blocks")
    wanted = write_table(members.join(split, F.col("comp") == F.col("c")).select("set_id", "who", "copies", "comp", "blocks"), "candidates")
    texts = with_row_key(docs, normalised(F.col(text_col)).cast("binary").alias("text"))
    small = F.broadcast(wanted) if fits_broadcast(wanted.select("set_id", "comp", "who.f")) else wanted
    placed = texts.join(small, (F.col(FILE) == F.col("who.f")) & (F.col(ROW) == F.col("who.r")))
    block = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    placed = placed.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = placed.select("comp", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "set_id", "block", "blocks", "copies", "text")
    units = units.repartition("comp", "a", "b").sortWithinPartitions("comp", "a", "b")
    told = write_table(verify(units, words, threshold), "links")

    whole = told.where("blocks = 1").select(F.col("set_id").alias("node"), "root")
    parts = components(told.where("blocks > 1").select(F.col("set_id").alias("u"), F.col("root").alias("v")))
    classes = whole.unionByName(parts)
    counted = told.groupBy(F.col("set_id").alias("t")).agg(F.sum("links").alias("links"))
    named = (sets.select("set_id", "who", "copies").join(classes, F.col("set_id") == F.col("node"), "left")
             .join(counted, F.col("set_id") == F.col("t"), "left")
             .select("set_id", "who", F.coalesce("root", "set_id").alias("root"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    named = write_table(named, "classes")
    heads = write_table(named.groupBy(F.col("root").alias("g")).agg(F.min("who").alias("head")), "heads")
    named = named.join(heads, F.col("root") == F.col("g")).select(F.col("set_id").alias("s"), "head", "n_links")
    joined = signed.select("doc_id", FILE, ROW, "set_id").join(named, F.col("set_id") == F.col("s"), "left")
    kept = F.col("head").isNull() | ((F.col("head.f") == F.col(FILE)) & (F.col("head.r") == F.col(ROW)))
    return joined.select(FILE, ROW, "doc_id", F.when(F.col("head").isNull(), F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
                         F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), kept.alias("kept"))


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One document of each class, with all its columns; documents without a class all stay."""
    docs = as_scan(docs)
    kept = join(docs, **options).where("kept").select(F.col(FILE).alias("f"), F.col(ROW).alias("r"))
    rows = with_row_key(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    return rows.join(kept, (F.col(FILE) == F.col("f")) & (F.col(ROW) == F.col("r")), "left_semi").select("doc.*")
