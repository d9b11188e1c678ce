"""Bins, time bands, labels, category codes, vectors."""

import math
from datetime import datetime, timezone

import pytest

from adsift.functions import features as FF
from adsift.operators import features as FE


def test_right_closed_bins(spark):
    th = [10, 100, 1000]
    vals = [(5.0,), (10.0,), (10.5,), (100.0,), (1000.0,), (1000.1,), (None,), (float("nan"),)]
    df = spark.createDataFrame(vals, "w double")
    got = [r[0] for r in df.select(FF.bin_right_closed("w", th)).collect()]
    assert got == [0.0, 0.0, 1.0, 1.0, 2.0, 3.0, None, 0.0]
    s = spark.createDataFrame([("12",), ("abc",)], "w string")
    assert [r[0] for r in s.select(FF.bin_right_closed("w", th)).collect()] == [1.0, None]
    size = spark.createDataFrame([(102400.0,), (102401.0,)], "w double")
    assert [r[0] for r in size.select(FF.bin_right_closed("w", FF.APPSIZE_THRESHOLDS)).collect()] == [1.0, 3.0]


def test_hour_band_and_weekday(spark):
    def ms(y, m, d, h):
        return int(datetime(y, m, d, h, tzinfo=timezone.utc).timestamp() * 1000)

    hours = [0, 1, 2, 7, 8, 13, 14, 19, 20, 23]
    df = spark.createDataFrame([(ms(2024, 1, 7, h),) for h in hours], "t bigint")
    got = [r[0] for r in df.select(FF.hour_band("t")).collect()]
    assert got == [3.0, 3.0, 0.0, 0.0, 1.0, 1.0, 2.0, 2.0, 3.0, 3.0]
    days = spark.createDataFrame([(ms(2024, 1, 7, 12),), (ms(2024, 1, 13, 12),)], "t bigint")  # Sun, Sat
    assert [r[0] for r in days.select(FF.day_of_week("t")).collect()] == [1.0, 7.0]


def test_event_label(spark):
    df = spark.createDataFrame([(FF.EVENT_EXPOSE,), (FF.EVENT_DETAIL,), (FF.EVENT_INSTALL,), ("x",), (None,)],
                               "e string")
    assert [r[0] for r in df.select(FF.event_label("e")).collect()] == [0.0, 1.0, 1.0, -1.0, -1.0]


def brute_codes(values):
    nn = sorted({v for v in values if v is not None})
    out = {v: float(i) for i, v in enumerate(nn)}
    out[None] = float(len(nn))
    return out


def test_category_codes_all_types(spark):
    rows = [("a", 3, 10, True, 1.5, None), ("b", 3, None, False, 10.0, "x"),
            ("a", 1, 7, True, 1.0e10, "x"), (None, 12, 7, None, 1.5, "x")]
    df = spark.createDataFrame(rows, "s string, i int, l bigint, b boolean, d double, one string")
    cols = df.columns
    d = FE.fit_codes(df, cols, partitions=3)
    got = {(r["feature"], r["value"]): r["code"] for r in d.collect()}
    text = {"s": ["a", "b", "a", None], "i": ["3", "3", "1", "12"], "l": ["10", None, "7", "7"],
            "b": ["true", "false", "true", None], "d": ["1.5", "10.0", "1.0E10", "1.5"],
            "one": [None, "x", "x", "x"]}
    for c, vals in text.items():
        want = brute_codes(vals)
        for v in set(vals):
            assert got[(c, v)] == want[v], (c, v)
    coded, _ = FE.multi_col_process(df.withColumn("k", df["s"]), "k", cols, d)
    first = coded.collect()[0]
    assert first["i"] == got[("i", "3")] and first["one"] == got[("one", None)]


def test_codes_unsupported_type_raises(spark):
    df = spark.createDataFrame([(1, [1])], "k int, a array<int>")
    with pytest.raises(TypeError):
        FE.fit_codes(df, ["a"])


def test_unseen_value_gets_extra_code(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    d = FE.fit_codes(train, ["c"])
    new = spark.createDataFrame([("b",), ("zzz",), (None,)], "c string")
    got = [r[0] for r in FE.apply_codes(new, d, ["c"]).collect()]
    assert sorted(got) == [1.0, 2.0, 2.0]


def test_many_values_across_partitions(spark):
    df = spark.range(0, 3000).selectExpr("cast(id * 7 % 1013 as string) as a", "cast(id % 17 as int) as b")
    d = FE.fit_codes(df, ["a", "b"], partitions=7)
    got = {(r[0], r[1]): r[2] for r in d.collect()}
    a_vals = sorted({str(i * 7 % 1013) for i in range(3000)})
    assert all(got[("a", v)] == float(i) for i, v in enumerate(a_vals))
    assert len(got) == len(a_vals) + 17


def test_assemble_and_one_hot(spark):
    from pyspark.ml.functions import vector_to_array

    df = spark.createDataFrame([(0, 1.0, 0.0), (1, 2.0, 1.0), (2, 0.0, 1.0)], "id int, a double, b double")
    v = FE.assemble(df, "id")
    assert [list(r[1]) for r in v.orderBy("id").collect()] == [[1.0, 0.0], [2.0, 1.0], [0.0, 1.0]]
    oh = FE.one_hot(df, ["a"]).orderBy("id").select(vector_to_array("a_vec").alias("x"))
    assert [r[0] for r in oh.collect()] == [[0.0, 1.0, 0.0], [0.0, 0.0, 1.0], [1.0, 0.0, 0.0]]


def test_event_features_and_instances(spark):
    ev = spark.createDataFrame(
        [("d1", 5, FF.EVENT_EXPOSE, 1704628800000, 2), ("d1", 5, FF.EVENT_DETAIL, 1704628800000, 1),
         ("d2", 6, "OTHER", 1704628800000, 2)],
        "imei string, app_id bigint, oper_type string, oper_time bigint, tracker_type int")
    f = FE.event_features(ev)
    assert f.columns == ["imei", "appid", "oper_type", "day_of_week", "hour_of_day"]
    assert sorted(r["oper_type"] for r in f.collect()) == [-1.0, 0.0]
    prof = spark.createDataFrame([("d1", 1.0), ("d2", 2.0)], "imei string, user_age double")
    apps = spark.createDataFrame([(5, 0.0)], "appid bigint, fcategoryid double")
    inst = FE.instances(f, prof, apps)
    assert inst.columns == ["oper_type", "user_age", "fcategoryid", "day_of_week", "hour_of_day"]
    assert inst.count() == 1
    assert not math.isnan(inst.first()["hour_of_day"])


def test_codes_without_broadcast(spark):
    df = spark.createDataFrame([("x", 1), ("y", None), ("x", 3)] * 10, "a string, b int")
    d = FE.fit_codes(df, ["a", "b"], partitions=2)
    coded = FE.apply_codes(df, d, ["a", "b"], max_rows=0)
    assert sorted({tuple(r) for r in coded.collect()}) == [(0.0, 0.0), (0.0, 1.0), (1.0, 2.0)]


def test_profile_sample_and_all_profiles(spark):
    df = spark.range(0, 500).selectExpr(
        "cast(id * 7919 % 500 as string) as imei", "cast(id % 5 as int) as user_age", "'m' as sex", "id as user_job",
        "true as marriage_status", "0.5D as mz_apps_car_owner", "cast(null as string) as user_network_type")
    assert [r["imei"] for r in FE.profile_sample(df, 3).collect()] == ["0", "1", "10"]
    assert FE.profile_features(df).count() == 500


def test_zones_with_daylight_saving(spark):
    from zoneinfo import ZoneInfo

    rows = [(zone, int(datetime(2023, m, d, h, 30, tzinfo=timezone.utc).timestamp() * 1000))
            for zone in ("Europe/Berlin", "America/New_York", "Australia/Lord_Howe", "Asia/Kolkata", "UTC")
            for m, d in ((3, 12), (3, 26), (4, 2), (7, 1), (10, 1), (10, 29), (11, 5), (12, 31)) for h in range(0, 24, 3)]
    df = spark.createDataFrame(rows, "zone string, t bigint")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", session)
            got = df.select("zone", "t", FF.day_of_week("t", df["zone"]).alias("d"), FF.hour_band("t", df["zone"]).alias("h")).collect()
            for r in got:
                wall = datetime.fromtimestamp(r["t"] / 1000, ZoneInfo(r["zone"]))
                assert r["d"] == wall.isoweekday() % 7 + 1 and r["h"] == (wall.hour + 22) % 24 // 6
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    one = df.select(FF.hour_band("t", "UTC").alias("a"), FF.hour_band("t").alias("b"), FF.day_of_week("t", "UTC").alias("c"), FF.day_of_week("t").alias("d"))
    assert all(r["a"] == r["b"] and r["c"] == r["d"] for r in one.collect())
    events = spark.createDataFrame([("d", 1, "x", 1704628800000, 2)], "imei string, app_id bigint, oper_type string, oper_time bigint, tracker_type int")
    assert FE.event_features(events, zone="Asia/Tokyo").first()["hour_of_day"] == 3.0 and FE.event_features(events).first()["hour_of_day"] == 1.0


def test_buckets_join_without_a_shuffle_of_events(spark):
    from adsift.plans.saved import tables
    from adsift.sinks.daily import save_day
    from adsift.sources.tables import day

    events = spark.range(0, 4000).selectExpr("cast(id % 300 as string) as imei", "id % 40 as appid", "cast(id % 3 as double) as oper_type",
                                             "1.0D as day_of_week", "2.0D as hour_of_day")
    profiles = spark.range(0, 280).selectExpr("cast(id as string) as imei", "cast(id % 9 as double) as sex")
    apps = spark.range(0, 35).selectExpr("id as appid", "cast(id % 4 as double) as fcategoryid")
    with tables(spark) as t:
        names = {k: f"{t['out']}_{k}" for k in ("e", "p", "a")}
        for d in (20240101, 20240102):
            save_day(events, names["e"], d, bucket=("imei", 4))
            save_day(profiles, names["p"], d, bucket=("imei", 4))
            save_day(apps, names["a"], d)
        e, p, a = (day(spark.table(n), 20240102).drop("stat_date") for n in names.values())
        got = FE.instances_of_buckets(e, p, a)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
        assert plan.count("Bucketed: true") >= 2
        want = FE.instances(events, profiles, apps)
        assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_snapshot_joins_its_narrow_sides_first(spark):
    """No attribute goes through the sort of the join by app and day."""
    from adsift.operators import merge as MG

    ads = spark.createDataFrame([(1, 20240101), (1, 20240102), (2, 20240101), (None, 20240101)], "appid long, stat_date long")
    apps = spark.createDataFrame([(k, f"n{k}", "c", "d", 1, 2, 3, 4, 5) for k in (1, 2, 3)],
                                 "fid long, fname string, fcategoryid string, fcategory2id string, fstatus int, fevaluate_count int, fdownload_count long, fstars int, finstall_count long")
    versions = spark.createDataFrame([(1, 20240101, 7), (1, 20240103, 8), (2, 20240101, 9), (3, 20240101, 9)], "appid long, stat_date long, appsize long")
    out = MG.merge_apps(ads, apps, versions, keys=("stat_date",))
    assert sorted((r["stat_date"], r["appid"], r["fname"], r["appsize"]) for r in out.collect()) == [(20240101, 1, "n1", 7), (20240101, 2, "n2", 9)]
    joins = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in x]
    assert len(joins) == 2 and "fid" in joins[0] and "stat_date" in joins[1]
