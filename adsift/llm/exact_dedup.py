"""Exact dedup: owners of equal texts in Patricia tries.

Texts are dealt out by length and content hash, and every partition inserts
the full byte strings into one compressed radix trie. A terminal node stores
the owner of its text and the number of rows that ended there.

* A first trie per scan task merges the task's own copies, so a text held by
  a third of all rows is sent at most once per task.
* The second trie gets rows in order of (length, hash), which are the first
  bytes of its keys. When it exceeds its budget, the subtrees left of the
  current key are finished; they are spilled to the result and cut off.
  The first trie spills whole subtrees early; the second merges the parts.

Rows then find their owner through length and SHA-256 of the text.

Defined cases: null and empty texts are equal and of length 0; a row with a
null id owns a text only if no row with an id has it; of rows with the same
id and text exactly one is kept; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import FILE, ROW, as_scan, with_row_key

TRIE_BYTES = 32 << 20
BATCH_ROWS = 2048
NODE_BYTES = 300  # a node's own cost beside its label


class Node:
    __slots__ = ("children", "count", "label", "owner")

    def __init__(self, label: bytes, owner=None, count: int = 0):
        self.label, self.owner, self.count = label, owner, count
        self.children: dict[int, Node] = {}


def shared_length(label: bytes, key: bytes, at: int) -> int:
    """How many first bytes of ``label`` stand in ``key`` at ``at``."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if key.startswith(label[low:mid], at + low):
            low = mid
        else:
            high = mid - 1
    return low


class PatriciaTrie:
    """Byte strings with an owner each: the best of those inserted (``best``)."""

    def __init__(self, best):
        self.best, self.root, self.held = best, Node(b""), 0

    def insert(self, key: bytes, owner, count: int = 1) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = child = Node(key[at:])
                self.held += len(child.label) + NODE_BYTES
                node, at = child, len(key)
                break
            if key.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            k = shared_length(child.label, key, at)
            fork = Node(child.label[:k])
            child.label = child.label[k:]
            fork.children[child.label[0]] = child
            node.children[key[at]] = fork
            self.held += NODE_BYTES
            node, at = fork, at + k
        node.owner = owner if not node.count else self.best(node.owner, owner)
        node.count += count

    def spill(self, before: bytes | None = None) -> Iterator[tuple[bytes, object, int]]:
        """Cut off the subtrees whose keys are all under ``before`` (None: all), in key order.

        Subtrees are read one by one and freed after; the path to ``before`` stays.
        """
        def under(node: Node, prefix: bytes):
            stack = [(node, prefix)]
            while stack:
                n, p = stack.pop()
                if n.count:
                    yield p, n.owner, n.count
                stack += [(n.children[b], p + n.children[b].label) for b in sorted(n.children, reverse=True)]

        node, prefix = self.root, b""
        if before is None and node.count:
            yield b"", node.owner, node.count
            node.owner, node.count = None, 0
        while True:
            onward = None
            for b in sorted(node.children):
                child = node.children[b]
                path = prefix + child.label
                if before is None or path[: len(before)] < before[: len(path)]:
                    yield from under(child, path)
                    del node.children[b]
                elif before[: len(path)] == path and len(path) < len(before):
                    onward = child
            if onward is None:
                break
            node, prefix = onward, prefix + onward.label
        self.held = 0 if before is None else sum(len(k) + NODE_BYTES for k, _, _ in under(node, prefix))


def largest(a, b):
    """The larger owner; an owner without id is below all others."""
    return max(a, b, key=lambda o: (o[0] is not None, o[0] or 0, o[1]))


def smallest(a, b):
    """The smaller owner; an owner without id comes after all others."""
    return min(a, b, key=lambda o: (o[0] is None, o[0] or 0, o[1]))


KEEP = {"largest": largest, "smallest": smallest}


def _prefix(length: int, content: int) -> bytes:
    return length.to_bytes(8, "big") + (content + (1 << 63)).to_bytes(8, "big")


PARTS = pa.schema([("length", pa.int64()), ("content", pa.int64()), ("bytes", pa.binary()),
                   ("owner", pa.int64()), ("tag", pa.int64()), ("n", pa.int64())])
OWNED = pa.schema([("length", pa.int64()), ("sha", pa.string()),
                   ("owner", pa.int64()), ("tag", pa.int64()), ("n", pa.int64())])


def _tried(batches, best, budget: int, schema: pa.Schema, row, ordered: bool):
    """Insert all rows into one trie; give ``row`` of each entry, spilled or left at the end."""
    trie, out, held = PatriciaTrie(best), [], 0

    def full():
        batch = pa.RecordBatch.from_pylist(out, schema=schema)
        out.clear()
        return batch

    def spilled(before=None):
        nonlocal held
        for key, owner, n in trie.spill(before):
            out.append(row(key, owner, n))
            held += len(key)
            if len(out) >= BATCH_ROWS or held > budget // 2:
                held = 0
                yield full()

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("length", "content", "bytes", "owner", "tag", "n")]
        for length, content, data, owner, tag, n in zip(*columns, strict=True):
            key = _prefix(length, content)
            if trie.held > budget:
                was = trie.held
                yield from spilled(key if ordered else None)
                # What is left shares the current key's length and hash: it has to stay.
                budget = max(budget, 2 * trie.held) if trie.held > was // 2 else budget
            trie.insert(key + (data or b""), (owner, tag), n)
    yield from spilled()
    if out:
        yield full()


def owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
           budget: int = TRIE_BYTES, content_hash=F.xxhash64) -> DataFrame:
    """One row per different text: length, sha (SHA-256), owner, tag (of the owner's row), n."""
    best = KEEP[keep]
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    keyed = with_row_key(docs, F.col(id_col).cast("long").alias("owner"), data.alias("bytes"))
    rows = keyed.select(F.length("bytes").cast("long").alias("length"), content_hash(F.col("bytes")).alias("content"), "bytes",
                        "owner", row_tag().alias("tag"), F.lit(1).cast("long").alias("n"))

    def part(key, owner, n):
        return {"length": int.from_bytes(key[:8], "big"), "content": int.from_bytes(key[8:16], "big") - (1 << 63),
                "bytes": key[16:], "owner": owner[0], "tag": owner[1], "n": n}

    def owned(key, owner, n):
        return {"length": int.from_bytes(key[:8], "big"), "sha": hashlib.sha256(key[16:]).hexdigest(),
                "owner": owner[0], "tag": owner[1], "n": n}

    local = rows.mapInArrow(lambda it: _tried(it, best, budget, PARTS, part, False),
                            "length long, content long, bytes binary, owner long, tag long, n long")
    dealt = local.repartition("length", "content").sortWithinPartitions("length", "content")
    return dealt.mapInArrow(lambda it: _tried(it, best, budget, OWNED, owned, True),
                            "length long, sha string, owner long, tag long, n long")


def row_tag() -> Column:
    """Tells rows with the same id apart."""
    return F.xxhash64(FILE, ROW)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
          columns: tuple[str, ...] = (), **options) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and struct doc of ``columns``."""
    docs = as_scan(docs)  # read twice below: rows must have the same places
    owned = owners(docs, id_col, text_col, keep, **options).select(
        F.col("length").alias("l"), F.col("sha").alias("s"), F.col("owner").alias("keep_id"), F.col("tag").alias("keep_tag"),
        F.col("n").alias("group_size"))
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    carried = [F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc")] if columns else []
    rows = with_row_key(docs, F.col(id_col).cast("long").alias("doc_id"), F.length(data).cast("long").alias("length"),
                        F.sha2(data, 256).alias("text_sha256"), *carried)
    joined = rows.join(owned, (F.col("length") == F.col("l")) & (F.col("text_sha256") == F.col("s")))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (row_tag() == F.col("keep_tag"))
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256", *(["doc"] if columns else []))


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay, with all their columns."""
    return dedup(docs, columns=tuple(docs.columns), **options).where("kept").select("doc.*")
