import hashlib

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from adsift.llm import queries as llm

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "labels")


def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_against_sql(spark, name):
    df = llm.queries()[name](spark, SF)
    rel = duck().execute(llm.oracle_sql()[name])
    names = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(names)
    order = lambda rows: sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))
    assert order([tuple(plain(r[n]) for n in names) for r in df.collect()]) == order([tuple(map(plain, r)) for r in rel.fetchall()])


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_take_effect(spark, docs):
    """Each stage on its own input, against what it must keep."""
    text = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    rows = [(i, text(i), "ab"[i % 2]) for i in range(20)] + [(50, text(3), "a"), (51, text(4) + " more", "b"), (52, None, None)]
    table = docs(rows)
    copies = corpus_pipeline.drop_copies(spark, table, SF)
    assert {r["doc_id"] for r in copies.collect()} == {r[0] for r in rows} - {3}
    near = corpus_pipeline.drop_near_copies(spark, table, SF)
    assert {r["doc_id"] for r in near.collect()} == {r[0] for r in rows} - {50, 51}
    assert copies.columns == near.columns == table.columns
    mixed = corpus_pipeline.mix_sources(spark, table, SF)
    assert mixed.columns == table.columns and {r["doc_id"] for r in mixed.collect()} <= {r[0] for r in rows}
    packed = corpus_pipeline.pack_sequences(spark, mixed, SF)
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").isEmpty()


def test_run_on_whole_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    digest = {r["doc_id"]: hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in docs.collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        before = {r["doc_id"] for r in kept.collect()}
        kept = stage(spark, kept, SF)
        ids = [r["doc_id"] for r in kept.collect()]
        assert kept.columns == docs.columns and set(ids) <= before and len(ids) > len(before) / 2, name
    assert len({digest[i] for i in ids}) == len(ids)
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in out} <= set(ids)
    first = [r for r in out if r["piece"] == 0]
    assert max(sum(r["doc_id"] == i for r in first) for i in {r["doc_id"] for r in first}) <= 3
