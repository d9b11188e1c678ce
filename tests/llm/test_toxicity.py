import random
import zlib

import numpy as np
import pytest

from adsift.llm import toxicity

MEAN = ["zorgle", "zorgla", "plimfa", "plimfo", "grontu"]


def corpus(rng, n):
    words = [a + b for a in ("ta", "lo", "mi", "ser", "van", "ku") for b in ("ne", "ri", "do", "sta", "pel", "oma")]
    out = []
    for i in range(n):
        text = rng.choices(words, k=rng.choice([5, 30, 200]))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(MEAN) + rng.choice(["", "s"])
        out.append((i, " ".join(text), int(toxic)))
    return out


@pytest.fixture(scope="module")
def trained():
    rows = corpus(random.Random(1), 500)
    return toxicity.fit([t.encode() for _, t, _ in rows], np.array([y for *_, y in rows]))


def test_new_documents_are_told_apart(trained):
    rows = corpus(random.Random(2), 300)
    score, _ = trained.scores([t.encode() for _, t, _ in rows])
    y = np.array([r[2] for r in rows])
    assert ((score >= 0.5) == y).mean() > 0.97
    assert (0 <= score).all() and (score <= 1).all()


def test_every_window_counts(trained):
    """One toxic passage anywhere in a long text is found, with its place."""
    calm = ["tane", "lori", "mido", "sersta"] * 1000
    alone, _ = trained.scores([" ".join(calm).encode()])
    assert alone[0] < 0.5
    for at in (0, 47, 2000, 3997):
        text = calm[:at] + ["zorgle", "plimfas", "grontu"] + calm[at:]
        score, where = trained.scores([" ".join(text).encode()])
        assert score[0] >= 0.5 and where[0] <= at < where[0] + toxicity.WINDOW


def test_windows_cover_all_words():
    for n in (0, 1, 63, 64, 65, 112, 113, 1000):
        starts = toxicity.windows_of(n)
        covered = np.zeros(n, bool)
        for s in starts:
            covered[s : s + toxicity.WINDOW] = True
        assert covered.all() and len(starts) >= 1 and (np.diff(starts) < toxicity.WINDOW).all()


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    net = toxicity.Network.new(rng)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, size, y = rng.normal(size=(6, 3, toxicity.INPUTS)).astype(np.float32), np.array([6, 4, 0]), np.array([1.0, 0.0, 1.0])
    importance = np.array([1.0, 2.0, 1.0])

    def loss():
        p = toxicity.sigmoid(net.logits(x, size).astype(np.float64))
        return float((-(y * np.log(p) + (1 - y) * np.log(1 - p)) * importance).mean())

    grads = net.gradients(x, size, y, importance)
    for name, value in net.p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in value.shape)
            value[at] += 1e-2
            up = loss()
            value[at] -= 2e-2
            down = loss()
            value[at] += 1e-2
            assert grads[name][at] == pytest.approx((up - down) / 2e-2, abs=2e-3), name


def test_segments_make_no_difference(monkeypatch):
    tables = {t: np.random.default_rng(3).normal(size=toxicity.BUCKETS).astype(np.float32) for t in toxicity.TABLES}
    text = " ".join(f"wörd{i % 91} x{i}" for i in range(3000)).encode()
    whole = toxicity.inputs_of(text, tables)
    monkeypatch.setattr(toxicity, "SEGMENT", 50)
    assert np.allclose(toxicity.inputs_of(text, tables), whole, atol=1e-6) and len(whole) == 6000


def test_tables(docs, spark):
    rows = corpus(random.Random(5), 400)
    rows[7:12] = [(7, "", 0), (8, None, 0), (9, "...", 1), (10, "tane", None), (11, "tane " * 30000, 1)]
    table = docs([(i, t) for i, t, _ in rows] + [(None, "tane"), (3, rows[3][1])])
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(3, 1, 0), (None, 1, 1), (99999, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(table, labels)
    out = toxicity.score(table, model).collect()
    assert len(out) == 402 and out[0].asDict().keys() == {"doc_id", "text", "lang", "source", "toxic_score", "toxic_word"}
    held = table.select(toxicity.held_out(table["doc_id"]).alias("h")).where("h").count()
    assert 40 < held < 130
    good = [(r["toxic_score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in out if r["doc_id"] is not None and not 7 <= r["doc_id"] <= 11]
    assert np.mean(good) > 0.9
    again = {(r["doc_id"], r["text"]): r["toxic_score"] for r in toxicity.score(table, toxicity.train(table, labels)).collect()}
    assert all(again[r["doc_id"], r["text"]] == r["toxic_score"] for r in out)
    odd = table.withColumnRenamed("lang", "words").withColumnRenamed("source", "toxic_score")
    assert toxicity.clean_documents(odd, model).columns == odd.columns
    assert toxicity.score(odd, model).columns == ["doc_id", "text", "words", "toxic_score", "toxic_word"]
    calm = toxicity.clean_documents(table, model)
    assert calm.columns == table.columns and calm.count() == sum(r["toxic_score"] < 0.5 for r in out)


def test_no_labels_and_no_rows(docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs([(1, "a")]), labels)
    assert [r["toxic_score"] for r in toxicity.score(docs([(1, "a")]), model).collect()] == [0.0]
    assert toxicity.score(docs([]), model).collect() == []
    clean = spark.createDataFrame([(i, 0, 0) for i in range(9)], "doc_id long, quality int, toxic int")
    assert [r["toxic_score"] for r in toxicity.score(docs([(1, "a")]), toxicity.train(docs([(i, "a") for i in range(9)]), clean)).collect()] == [0.0]


def test_sample_is_filled_from_rows_that_qualify(docs, spark, monkeypatch):
    """Long toxic texts take no places; if all are too long, that is an error and not a model without a network."""
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, "vile " * (400 if i % 4 < 3 else 4) if i % 2 else "kind words") for i in ids]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, y, share: seen.append((len(texts), int(y.sum()))))
    most = sum(1 for i, t in rows if i % 2 and len(t) < 100) // 2
    toxicity.train(docs(rows), labels, most_toxic=most, most_clean=5, most_chars=100)
    assert seen == [(most + 5, most)]
    with pytest.raises(ValueError, match="both labels"):
        toxicity.train(docs(rows), labels, most_chars=15)
