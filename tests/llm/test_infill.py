import hashlib
import random
import re

import numpy as np
import pytest

from adsift.llm import infill, queries


def plain_way(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by splitting the text."""
    text = text or ""
    parts = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(parts)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (parts[:a], parts[a:b], parts[b:]))
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts(n=400):
    rng = random.Random(11)
    pieces = ["a", "Zq", "é", "山", "😀", " ", "\n", "1", "<", "<P", "S>", "<M", ">", "<S >", "\u0000x", "word"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(n)]


EDGES = [None, "", "x", "é", "<P>", "a<S>b", "<M", "ab", "<", ">", "<P><S><M>", "<<P", "word " * 3]


def test_against_plain_splitting(spark, docs):
    rows = list(enumerate(EDGES + texts())) + [(3, "same id"), (3, "same id")]
    df = docs(rows, partitions=4)
    out = infill.restore(infill.transform(df))
    want = sorted(((i, *plain_way(i, t), t or "") for i, t in rows), key=repr)
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == want
    assert {f for _, _, f, *_ in want} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("slab,block,most", [(1, 1, 1), (3, 2, 50), (7, 5, 1 << 20)])
def test_slabs_blocks_and_batches(monkeypatch, slab, block, most):
    monkeypatch.setattr(infill, "SLAB", slab)
    monkeypatch.setattr(infill, "BLOCK", block)
    made = texts(60)
    data = np.frombuffer("".join(made).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in made])])
    seen = 0
    for i, j in infill.runs(offsets, most):
        part, bounds = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        told = list(infill.split(list(range(i, j)), part, bounds))
        out, at = infill.scatter(part, bounds, [t[1] for t in told], [t[2] for t in told])
        for k in range(j - i):
            n, form, prefix, middle, text = plain_way(i + k, made[i + k])
            assert (told[k][0], told[k][1], told[k][3], told[k][4]) == (n, form, prefix, middle)
            assert out[at[k] : at[k + 1]].tobytes().decode() == text
        back, ends = infill.gather(out, at, [t[1] for t in told])
        assert back.tobytes() == part.tobytes() and np.array_equal(ends, bounds)
        seen += j - i
    assert seen == len(made)


def test_long_text_null_id_and_columns(spark):
    long = "Ab é. " * 300_000
    rows = [(None, "no id here", "x", 1), (7, long, "y", 2), (8, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string, output int")
    out = {r["doc_id"]: r for r in infill.restore(infill.transform(df, columns=("form", "output"))).collect()}
    assert out[7]["restored"] == long and out[7]["n"] == plain_way(7, long)[0] and out[7]["output"] == plain_way(7, long)[4]
    assert out[7]["doc"].asDict() == {"form": "y", "output": 2}
    assert out[8]["form"] == "plain" and out[8]["restored"] == "" and out[8]["doc"]["form"] is None
    assert out[None]["restored"] == "no id here"
    empty = infill.restore(infill.transform(df.limit(0)))
    assert empty.collect() == []


def test_wrong_outputs_are_errors():
    for text, form in (("no markers", "psm"), ("<P>a<S>b", "psm"), ("<P>a<S>b<M>c<M>", "psm"), ("x<P>a<S>b<M>c", "psm"), ("<P>a<S>b<M>c", "spm")):
        data = np.frombuffer(text.encode(), np.uint8)
        with pytest.raises(ValueError):
            infill.gather(data, np.array([0, len(data)]), [form])


def test_query_restores_every_document(spark):
    sf = "/root/testdata/sf0.001"
    out = queries.op11_fill_in_middle(spark, sf)
    want = {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r["doc_id"]: r["restored_sha256"] for r in out.collect()} == want
    assert out.count() == len(want)
