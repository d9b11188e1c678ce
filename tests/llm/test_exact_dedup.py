import hashlib
import random
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adsift.llm import exact_dedup


def brute(rows, best=max):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    return groups


def check(rows, out):
    groups = brute(rows)
    assert len(out) == len(rows)
    kept = defaultdict(int)
    for r in out:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        ids = groups[text]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
        kept[text] += r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert all(n == 1 for n in kept.values()) and len(kept) == len(groups)


def test_against_brute_force(docs):
    rng = random.Random(3)
    texts = ["", None, "a", "ab", "abc", "abd", "A", "ab " * 5000, "ab " * 4999 + "ac ", "é", "e\u0301", "日本"]
    rows = [(i, rng.choice(texts)) for i in range(200)] + [(None, "abc"), (None, "only null"), (7, "twice"), (7, "twice"), (None, "null twice"), (None, "null twice")]
    check(rows, exact_dedup.dedup(docs(rows)).collect())


def test_equal_hashes_and_spills(docs):
    """All texts of a length get one hash and the budget is tiny: only the trie tells texts apart."""
    rows = [(i, f"{i % 37:02d}" * 10) for i in range(300)]
    check(rows, exact_dedup.dedup(docs(rows), budget=1000, content_hash=lambda c: F.lit(5).cast("long")).collect())


def test_smallest_and_columns_stay(docs):
    rows = [(3, "x", "a"), (1, "x", "b"), (None, "x", "c"), (2, "y", "d")]
    out = exact_dedup.deduplicated(docs(rows), keep="smallest")
    assert out.columns == ["doc_id", "text", "lang", "source"]
    assert sorted((r["doc_id"], r["source"]) for r in out.collect()) == [(1, "b"), (2, "d")]


def test_empty_table_and_clashing_columns(docs):
    assert exact_dedup.dedup(docs([])).collect() == []
    odd = docs([(1, "x"), (2, "x")]).withColumnRenamed("lang", "length").withColumnRenamed("source", "keep_id")
    assert [r["doc_id"] for r in exact_dedup.deduplicated(odd).collect()] == [2]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), max_size=60), st.integers(0, 40))
def test_trie_against_dict(keys, cut):
    trie, out = exact_dedup.PatriciaTrie(max), defaultdict(list)
    for i, key in enumerate(sorted(keys)):
        if i == cut:
            for k, owner, n in trie.spill(key):
                assert k < key
                out[k].append((owner, n))
        trie.insert(key, i)
    for k, owner, n in trie.spill():
        out[k].append((owner, n))
    want = defaultdict(list)
    for i, key in enumerate(sorted(keys)):
        want[key].append(i)
    assert {k: (max(o for o, _ in v), sum(n for _, n in v)) for k, v in out.items()} == {k: (max(v), len(v)) for k, v in want.items()}
