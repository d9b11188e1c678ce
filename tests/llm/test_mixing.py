import random

import pytest

from adsift.llm import mixing


def water(sizes, weights=(5, 2, 1), most=3):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, fixed = {}, set()
    whole = sum(sizes.values())
    while True:
        left = whole - sum(most * sizes[s] for s in fixed)
        open_ = [s for s in names if s not in fixed]
        total = sum(w[s] for s in open_)
        target = {s: most * sizes[s] if s in fixed else left * w[s] / total for s in names}
        over = {s for s in open_ if target[s] > most * sizes[s] + 1e-9}
        if not over:
            return target
        fixed |= over


def test_targets_and_copies(docs):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice("aaaaaabcd")) for i in range(600)]
    rows += [(None, "x y", "b"), (1, None, "c"), (1, None, "c"), (900, "v w", None), (901, "many " * 400, "a")]
    out = mixing.mix(docs(rows)).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = water(sizes)
    assert len(out) == len(rows)
    taken, largest = {}, {}
    for r in out:
        s = r["source"]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["copies"] <= 3
        taken[s] = taken.get(s, 0) + r["copies"] * r["size"]
        largest[s] = max(largest.get(s, 0), r["size"])
    for s in sizes:
        # In order of size, no prefix is off by a whole document, so the words are off by the largest at most.
        assert abs(taken[s] - want[s]) <= largest[s]
    assert largest["a"] < want["a"] / 20


def test_reruns_agree_and_documents_repeat(docs):
    table = docs([(i, f"doc {i} " * (i % 7), "ab"[i % 2]) for i in range(100)])
    first = sorted((r["doc_id"], r["copies"]) for r in mixing.mix(table).collect())
    assert first == sorted((r["doc_id"], r["copies"]) for r in mixing.mix(table).collect())
    out = mixing.mixed_documents(table)
    assert out.columns == table.columns
    got = {}
    for r in out.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {i: n for i, n in first if n}


def test_no_rows_and_no_words(docs):
    assert mixing.mix(docs([])).collect() == []
    out = mixing.mix(docs([(1, "", "a"), (2, None, None)])).collect()
    assert [(r["target"], r["copies"]) for r in out] == [(0.0, 0), (0.0, 0)]
    assert mixing.mixed_documents(docs([(1, "", "a")])).count() == 0
