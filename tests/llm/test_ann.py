import numpy as np

from adsift.llm import ann

SCHEMA = "vec_id long, embedding array<float>, score double"


def brute(rows, k=5):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and None not in v and len(v) == 8
          and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, np.float32))]
    seen = {}
    for i, v in ok:
        seen[i, v.tobytes()] = (i, v)
    out = {}
    for q, v in seen.values():
        if q % 50 == 0:
            near = sorted((-float((v / np.linalg.norm(v)) @ (w / np.linalg.norm(w))), i) for i, w in seen.values() if i != q)
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def test_small_tables_are_exact(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)]
    same = rng.normal(size=8).tolist()
    rows += [(i, same) for i in range(400, 700)] + [(700, None), (750, [0.0] * 8), (800, [float("nan")] * 8), (850, [None] * 8),
                                                    (900, [1.0, 2.0]), (None, same), (950, [float("inf")] + [1.0] * 7), (50, rows[50][1]), (1000, [])]
    spark.createDataFrame([(i, v, 0.5) for i, v in rows], SCHEMA).write.parquet(str(tmp_path / "v"))
    table = spark.read.parquet(str(tmp_path / "v"))
    want = brute(rows)
    for options in ({}, {"leaf_points": 16, "sample": 64, "least": 10**6}, {"leaf_points": 64, "most_points": 7, "least": 10**6}):
        got = {}
        for r in ann.nearest(table, lambda c: c % 50 == 0, **options).collect():
            got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
        assert set(got) == set(want)
        for q, near in want.items():
            assert [got[q][i + 1][0] for i in range(5)] == [i for i, _ in near], q
            assert np.allclose([got[q][i + 1][1] for i in range(5)], [s for _, s in near], atol=1e-12)


def test_few_candidates_and_none(spark, tmp_path):
    table = spark.createDataFrame([(0, [1.0, 0.0], 0.0), (1, [1.0, 1.0], 0.0), (2, [-1.0, 0.0], 0.0)], SCHEMA)
    assert [(r["rank"], r["vec_id"]) for r in ann.nearest(table, lambda c: c % 50 == 0).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert ann.nearest(table.limit(0), lambda c: c % 50 == 0).collect() == []
    assert ann.nearest(table.where("vec_id > 0"), lambda c: c % 50 == 0).collect() == []


def test_recall_of_the_forest():
    """Against brute force, on clusters whose nearest neighbours hardly differ."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(10, 32))[rng.integers(0, 10, 12000)] * 0.7 + rng.normal(size=(12000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    forest = ann.fit_forest(x[:4000], len(x))
    cells = [t.route(x) for t in forest.trees]
    leaves = ann.leaves_for(forest, len(x))
    found = 0
    for q, taken in zip(range(0, 12000, 50), ann.search(forest, x[::50], leaves), strict=True):
        near = np.unique(np.concatenate([np.flatnonzero(cells[t] == leaf) for t, leaf in taken]))
        best = set(np.argsort(-(x @ x[q]))[:6].tolist()) - {q}
        found += len(best & set(near.tolist()))
    assert found >= 0.9 * 5 * 240


def test_levels_below_the_sample():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    forest = ann.fit_forest(x[:64], len(x), leaf_points=32)
    assert forest.trees[0].depth == 3 and forest.trees[0].levels == 7
    sizes = np.bincount(forest.trees[0].route(x), minlength=128)
    assert sizes.max() < 8 * 32
    for q, taken in zip(x[:5], ann.search(forest, x[:5], 64), strict=True):
        assert set(taken) & {(t, tree.route(q[None])[0]) for t, tree in enumerate(forest.trees)}
    everything = ann.search(forest, x[:1], 10**9)[0]
    assert len(set(everything)) == len(forest.trees) * 128
