import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adsift.llm import components, ngram_join


def grams(text, n=5):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return {tuple(words[i : i + n]) for i in range(max(len(words) - n, 0) + 1)} if words else set()


def brute(rows, threshold=0.8):
    sets = [grams(t) for _, t in rows]
    near = [[i != j and bool(a) and len(a & b) >= threshold * len(a | b) - 1e-9 for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            least = min([label[j] for j in range(len(rows)) if near[i][j]] + [label[i]])
            changed |= least < label[i]
            label[i] = least
    key = lambda i: (rows[i][0] is None, rows[i][0] or 0)
    first = {k: rows[min((i for i in range(len(rows)) if label[i] == k), key=key)][0] for k in set(label)}
    return [(first[label[i]], sum(near[i])) for i in range(len(rows))], len(set(label))


def corpus(rng, n=40):
    vocabulary = [f"w{i}" for i in range(300)]
    rows, base = [], [rng.choices(vocabulary, k=rng.randint(3, 120)) for _ in range(n)]
    for words in base:
        for _ in range(rng.choice([1, 1, 1, 2, 6])):
            copy = list(words)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    long = rng.choices(vocabulary, k=400)
    for i in range(70):  # one large group of near copies
        copy = list(long)
        copy[rng.randrange(400)] = f"n{i % 50}"
        copy[rng.randrange(400)] = f"m{i}"
        rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + i, t) for i, t in enumerate(["", None, "!!!", "one", "One.", "a b c d", "A b, c d", "a b c d e", "Ü b c d e f", "ü B c d e f"])]
    return rows + [(None, rows[0][1]), (3, rows[3][1]), (3, rows[3][1])]


@pytest.mark.parametrize("options", [{}, {"block_members": 16}, {"block_shingles": 3000}])
def test_against_brute_force(docs, options):
    rows = corpus(random.Random(4))
    out = ngram_join.join(docs(rows), **options).collect()
    want, classes = brute(rows)
    key = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in out), key=key) == sorted(((d, *w) for (d, _), w in zip(rows, want, strict=True)), key=key)
    assert sum(r["kept"] for r in out) == classes


def test_one_of_each_group_stays(docs):
    text = " ".join(f"t{i}" for i in range(60))
    rows = [(5, text), (2, text + " end"), (9, "other words that are not alike at all"), (None, text), (7, "")]
    out = ngram_join.deduplicated(docs(rows))
    assert out.columns == ["doc_id", "text", "lang", "source"]
    assert sorted(r["doc_id"] for r in out.collect()) == [2, 7, 9]
    assert ngram_join.join(docs([])).collect() == []
    assert [r["n_links"] for r in ngram_join.join(docs([(1, None), (1, None)])).collect()] == [0, 0]


def test_long_texts_go_in_steps(monkeypatch):
    text = " ".join(f"word{i}" for i in range(5000)).encode()
    whole = ngram_join.shingles(text)
    monkeypatch.setattr(ngram_join, "TEXT_STEP", 100)
    assert (ngram_join.shingles(text) == whole).all() and len(whole) == 4996


def test_bands_reach_the_recall():
    bands, rows = ngram_join.choose_bands(0.8, 0.999, 128)
    assert bands * rows <= 128 and 1 - (1 - 0.8**rows) ** bands >= 0.999
    assert 1 - (1 - 0.8 ** (rows + 1)) ** (128 // (rows + 1)) < 0.999
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.01, 0.999, 16)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1), min_size=1, max_size=12), st.integers(0, 3))
def test_common_counts(sets, sparse):
    old, ngram_join.SPARSE = ngram_join.SPARSE, sparse
    try:
        got = ngram_join.common_counts([np.array(sorted(s), np.uint64) for s in sets])
    finally:
        ngram_join.SPARSE = old
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j:
                assert got[i, j] == len(a & b)


def test_components_against_union_find(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)] + [(500, i) for i in range(501, 560)]
    root = {x: x for e in edges for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((top(a), top(b)))
        root[high] = low
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: top(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []
