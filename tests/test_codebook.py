"""Dictionaries by day: codes that stay, the ML estimator, scoring with an earlier day."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler

from adsift.operators import codebook as CB
from adsift.operators import features as FE
from adsift.plans.saved import tables


def rows(spark, values):
    return spark.createDataFrame(values, "a string, b int")


DAYS = [[("x", 3), ("c", 3), ("c", None)], [("b", 20), ("x", 3), (None, 100), ("d", None)], [("a", 3), ("b", 20)]]


def plain(days):
    """Codes of each column, day by day."""
    out = {"a": {}, "b": {}}
    added = []
    for k, day in enumerate(days):
        for i, c in enumerate("ab"):
            fresh = sorted({str(r[i]) for r in day if r[i] is not None} - set(out[c]))
            if k == 0:
                now = {v: float(j) for j, v in enumerate(fresh)} | {None: float(len(fresh))}
            else:
                now = {v: max(out[c].values()) + 1 + j for j, v in enumerate(fresh)}
            out[c] |= now
            added += [(20240101 + k, c, v, code) for v, code in now.items()]
    return out, sorted(added, key=repr)


def test_codes_stay_over_days(spark):
    want, added = plain(DAYS)
    with tables(spark) as t:
        for k, values in enumerate(DAYS):
            model = CB.CategoryCoder(inputCols=["a", "b"], table=t["out"], day=20240101 + k).fit(rows(spark, values))
            upto, _ = plain(DAYS[: k + 1])
            assert {(r[0], r[1]): r[2] for r in model.dictionary(spark).collect()} == {(c, v): x for c in upto for v, x in upto[c].items()}
        assert sorted((tuple(r) for r in spark.table(t["out"]).select("stat_date", "feature", "value", "code").collect()), key=repr) == added
        # The last day again: the same rows.
        CB.CategoryCoder(inputCols=["a", "b"], table=t["out"], day=20240103).fit(rows(spark, DAYS[2]))
        assert sorted((tuple(r) for r in spark.table(t["out"]).select("stat_date", "feature", "value", "code").collect()), key=repr) == added
        with pytest.raises(ValueError, match="20240103"):
            CB.CategoryCoder(inputCols=["a", "b"], table=t["out"], day=20240102).fit(rows(spark, DAYS[1]))
        old = CB.CategoryCoderModel(inputCols=["a", "b"], table=t["out"], day=20240101)
        got = [tuple(r) for r in old.transform(rows(spark, [("b", 20), ("x", 3), (None, None), ("c", 3)])).collect()]
        assert got == [(2.0, 1.0), (1.0, 0.0), (2.0, 1.0), (0.0, 0.0)]    # unseen values have the code of NULL


def test_a_day_without_new_values_or_rows(spark):
    with tables(spark) as t:
        CB.CategoryCoder(inputCols=["a", "b"], table=t["out"], day=1).fit(rows(spark, DAYS[0]))
        CB.CategoryCoder(inputCols=["a", "b"], table=t["out"], day=2).fit(rows(spark, DAYS[0]))
        model = CB.CategoryCoder(inputCols=["a", "b"], table=t["out"], day=3).fit(rows(spark, []))
        assert model.dictionary(spark).count() == 5 and spark.table(t["out"]).where("stat_date > 1").count() == 0
    with tables(spark) as t:
        first = CB.CategoryCoder(inputCols=["a", "b"], table=t["out"], day=1).fit(rows(spark, []))
        assert sorted(tuple(r) for r in first.dictionary(spark).collect()) == [("a", None, 0.0), ("b", None, 0.0)]


def test_first_day_equals_a_plain_fit(spark):
    df = spark.range(0, 2000).selectExpr("cast(id * 7 % 613 as string) as a", "cast(if(id % 5 = 0, null, id % 31) as int) as b")
    with tables(spark) as t:
        got = {(r[0], r[1]): r[2] for r in CB.CategoryCoder(inputCols=["a", "b"], table=t["out"], day=1).fit(df).dictionary(spark).collect()}
    want = {(r[0], r[1]): r[2] for r in FE.fit_codes(df, ["a", "b"]).collect()}
    assert got == want | {("a", None): 613.0}


def test_many_new_values_and_shuffled_anti_join(spark, monkeypatch):
    monkeypatch.setattr(CB, "fits_broadcast", lambda t: False)
    one = spark.range(0, 500).selectExpr("cast(id * 2 as string) as a", "cast(1 as int) as b")
    two = spark.range(0, 1000).selectExpr("cast(id as string) as a", "cast(id % 3 as int) as b")
    with tables(spark) as t:
        CB.CategoryCoder(inputCols=["a", "b"], table=t["out"], day=1).fit(one)
        model = CB.CategoryCoder(inputCols=["a", "b"], table=t["out"], day=2).fit(two)
        got = {r[1]: r[2] for r in model.dictionary(spark).where("feature = 'a'").collect()}
    even, odd = (sorted(str(i) for i in range(k, 1000, 2)) for k in (0, 1))
    assert got == {v: float(i) for i, v in enumerate(even)} | {None: 500.0} | {v: 501.0 + i for i, v in enumerate(odd)}


def test_pipeline_save_and_load(spark, tmp_path):
    with tables(spark) as t:
        df = rows(spark, DAYS[0])
        pipeline = Pipeline(stages=[CB.CategoryCoder(inputCols=["a", "b"], table=t["out"], day=5), VectorAssembler(inputCols=["a", "b"], outputCol="v")])
        pipeline.fit(df).write().overwrite().save(str(tmp_path / "model"))
        CB.CategoryCoder(inputCols=["a", "b"], table=t["out"], day=6).fit(rows(spark, DAYS[1]))
        again = PipelineModel.load(str(tmp_path / "model"))
        assert [list(r["v"]) for r in again.transform(rows(spark, [("x", 3), ("b", 20), (None, None)])).collect()] == [[1.0, 0.0], [2.0, 1.0], [2.0, 1.0]]
        coder = CB.CategoryCoder(inputCols=["a"], table=t["out"], day=7)
        coder.write().overwrite().save(str(tmp_path / "coder"))
        back = CB.CategoryCoder.load(str(tmp_path / "coder"))
        assert (back.getInputCols(), back.getTable(), back.getDay()) == (["a"], t["out"], 7)
