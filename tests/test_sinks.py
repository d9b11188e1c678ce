"""Day sink: re-run replaces a day, other days stay, an empty day clears."""

import pytest

from adsift.sinks.daily import save_day, save_match


def test_day_overwrite(spark):
    t = "sink_days"
    a = spark.createDataFrame([("x", 1), ("y", 2)], "w string, cnt bigint")
    save_day(a, t, 20240101)
    save_day(a.limit(1), t, 20240102)
    assert spark.table(t).count() == 3
    save_day(spark.createDataFrame([("z", 9)], "w string, cnt bigint"), t, 20240101)
    rows = {(r["w"], r["stat_date"]) for r in spark.table(t).collect()}
    assert rows == {("z", 20240101), ("x", 20240102)}
    save_day(a.where("cnt > 10"), t, 20240102)
    assert {r["stat_date"] for r in spark.table(t).collect()} == {20240101}


def test_sink_types(spark):
    df = spark.createDataFrame([(1, [1])], "k int, a array<int>")
    with pytest.raises(TypeError):
        save_day(df, "sink_bad", 1)
    d = spark.createDataFrame([(1.5,)], "x double")
    with pytest.raises(TypeError):
        save_day(d, "sink_bad2", 1, allowed=("int", "bigint", "string"))


def test_match_sink_renames(spark):
    df = spark.createDataFrame([("red", 3)], "search_word string, cnt bigint")
    save_match(df, "exact-match", "sink_exact", 20240101)
    assert spark.table("sink_exact").columns == ["keyword", "cnt", "stat_date"]


def test_columns_go_by_name(spark):
    t = "sink_named"
    save_day(spark.createDataFrame([(1, 10)], "x int, y int"), t, 20240101)
    save_day(spark.createDataFrame([(20, 2)], "y int, x int"), t, 20240102)
    assert sorted((r["x"], r["y"]) for r in spark.table(t).collect()) == [(1, 10), (2, 20)]
    for odd in ("x int", "x int, y int, z int", "x int, y string", "x int, w int"):
        with pytest.raises(ValueError):
            save_day(spark.createDataFrame([], odd), t, 20240101)
    assert spark.table(t).count() == 2


def test_range_equals_day_by_day(spark):
    from adsift.plans.saved import tables
    from adsift.sinks.daily import calendar_days, save_day, save_range

    rows = [(f"w{i}", i, 20240227 + i % 3 if i % 3 < 2 else 20240301) for i in range(50)]
    df = spark.createDataFrame(rows, "word string, n int, stat_date bigint")
    days = calendar_days(20240226, 20240303)
    assert days == [20240226, 20240227, 20240228, 20240229, 20240301, 20240302]
    with tables(spark) as t:
        one, many = f"{t['out']}_one", f"{t['out']}_many"
        for table in (one, many):
            for d in (20240225, 20240226, 20240302, 20240303):    # two in the range, to be emptied
                save_day(df.limit(2).drop("stat_date"), table, d)
        told = save_range(df.select("stat_date", "n", "word"), many, 20240226, 20240303)
        for d in days:
            save_day(df.where(f"stat_date = {d}").drop("stat_date"), one, d)
        assert sorted(map(tuple, spark.table(one).collect())) == sorted(map(tuple, spark.table(many).collect()))
        assert sorted(map(tuple, told.collect())) == [(d, sum(r[2] == d for r in rows)) for d in days]
        save_range(df.where("stat_date = 20240227"), many, 20240227, 20240229)
        assert {r["stat_date"]: r["rows"] for r in spark.table(f"{many}_manifest").collect()}[20240228] == 0
        assert spark.table(many).where("stat_date = 20240301").count() == sum(r[2] == 20240301 for r in rows)
        with pytest.raises(ValueError, match="outside"):
            save_range(df, many, 20240227, 20240228)
        with pytest.raises(ValueError, match="fit"):
            save_range(df.withColumn("more", df["n"]), many, 20240226, 20240303)
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
