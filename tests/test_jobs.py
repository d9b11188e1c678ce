"""The four jobs end to end on catalogue tables: read, plan, write one day."""

import json

from adsift import jobs
from adsift.operators.matching import MODES


def test_match_job_modes(spark):
    spark.createDataFrame([(" red ", 20240101), ("blue", 20231201)], "fkey_words string, stat_date bigint") \
        .write.mode("overwrite").saveAsTable("job_bids")
    spark.createDataFrame([("red ball", 20240102), ("red ball", 20240102), ("red", 20240103), ("green", 20240102),
                           ("red", 20231231)], "keyword string, stat_date bigint") \
        .write.mode("overwrite").saveAsTable("job_searches")
    _, sizes = jobs.match_job(spark, "exact-match", 20240101, 20240201, 20240131, "job_bids", "job_searches",
                              "job_exact")
    assert [tuple(r) for r in spark.table("job_exact").collect()] == [("red", 1, 20240131)]
    assert sizes == {"bid_words": 2, "search_words": 3}
    jobs.match_job(spark, "exact-include", 20240101, 20240201, 20240131, "job_bids", "job_searches", "job_inc")
    assert sorted(tuple(r) for r in spark.table("job_inc").collect()) == [("red", 1, 20240131),
                                                                        ("red ball", 2, 20240131)]
    jobs.match_job(spark, "get-data", 20240101, 20240201, 20240131, "job_bids", "job_searches", "job_pairs")
    got = dict((r[0], r[1]) for r in spark.table("job_pairs").collect())
    assert got == {"red ball": "red,2 red,3", "red": "red,1", "green": ""}


def test_flatten_job(spark):
    logs = [(json.dumps({"imei": "d1", "event_content": {"keyword": "k", "ads": [{"app_id": 1}, {"app_id": 2}]}}),
             20240101), ("oops", 20240101), ("{}", 20240102)]
    spark.createDataFrame(logs, "vcontent string, stat_date bigint").write.mode("overwrite").saveAsTable("job_logs")
    jobs.flatten_job(spark, "job_logs", 20240101, "job_flat")
    rows = spark.table("job_flat").collect()
    assert len(rows) == 3 and {r["stat_date"] for r in rows} == {20240101}
    assert sorted(r["app_id"] for r in rows) == ["", "1", "2"]


def test_app_merge_and_instances_jobs(spark):
    d = 20240107
    spark.createDataFrame([(1, d), (1, d), (2, d), (3, d), (9, d - 1)], "fappid int, stat_date bigint") \
        .write.mode("overwrite").saveAsTable("job_ads")
    spark.createDataFrame([(1, "one", "c1", "x", 1, 5, 50000, 20, 100, d), (2, "two", "c2", "y", 1, 500, 5, 2000, 10, d),
                           (3, "three", "c1", "x", 0, 50, 500, 200, 1, d)],
                          "fid int, fname string, fcategoryid string, fcategory2id string, fstatus int, "
                          "fevaluate_count int, fdownload_count bigint, fstars int, finstall_count bigint, stat_date bigint") \
        .write.mode("overwrite").saveAsTable("job_apps")
    spark.createDataFrame([(1, 20480, d), (1, 4096, d), (2, 2000000, d)], "fappid int, fsize bigint, stat_date bigint") \
        .write.mode("overwrite").saveAsTable("job_vers")
    jobs.app_merge_job(spark, "job_ads", "job_apps", "job_vers", d, "job_snap")
    snap = {r["appid"]: r["appsize"] for r in spark.table("job_snap").collect()}
    assert snap == {1: 20480, 2: 2000000}
    spark.createDataFrame([("u1", 30, "m", 1, True, 2.0, "4g"), ("u2", 40, "f", 2, False, 3.0, None)],
                          "imei string, user_age int, sex string, user_job bigint, marriage_status boolean, "
                          "mz_apps_car_owner double, user_network_type string") \
        .write.mode("overwrite").saveAsTable("job_profiles")
    ms = 1704628800000  # 2024-01-07 12:00 UTC, a Sunday
    spark.createDataFrame([("u1", 1, "AD_MQ_EVENT_CPD_EXPOSE", ms, 2, d), ("u2", 2, "AD_MQ_EVENT_CPD_INSTALL", ms, 2, d),
                           ("u2", 2, "AD_MQ_EVENT_CPD_DETAIL", ms, 1, d)],
                          "imei string, app_id int, oper_type string, oper_time bigint, tracker_type int, stat_date bigint") \
        .write.mode("overwrite").saveAsTable("job_events")
    inst = jobs.instances_job(spark, "job_profiles", "job_snap", "job_events", d, "job_feat")
    rows = spark.table("job_feat_instances").collect()
    assert len(rows) == 2
    assert inst.columns[0] == "oper_type"
    assert sorted(r["oper_type"] for r in rows) == [0.0, 1.0]
    assert {r["day_of_week"] for r in rows} == {1.0} and {r["hour_of_day"] for r in rows} == {1.0}


def test_cli_match(spark):
    spark.createDataFrame([("red", 20240101)], "fkey_words string, stat_date bigint") \
        .write.mode("overwrite").saveAsTable("cli_bids")
    spark.createDataFrame([("red", 20240102), ("blue", 20240102)], "keyword string, stat_date bigint") \
        .write.mode("overwrite").saveAsTable("cli_searches")
    jobs.main(["match", "exact-include", "20240101", "20240201", "20240131",
               "--bids", "cli_bids", "--searches", "cli_searches", "--out", "cli_out"])
    assert [tuple(r) for r in spark.table("cli_out").collect()] == [("red", 1, 20240131)]


def test_snapshot_rejects_other_types(spark):
    import pytest

    from adsift.operators.merge import merge_apps

    ads = spark.createDataFrame([(1,)], "appid int")
    apps = spark.createDataFrame([(1, "a", "c", "d", 1, 1, 1, 1.5, 1)],
                                 "fid int, fname string, fcategoryid string, fcategory2id string, fstatus int, "
                                 "fevaluate_count int, fdownload_count int, fstars double, finstall_count int")
    vers = spark.createDataFrame([(1, 10)], "appid int, appsize int")
    with pytest.raises(TypeError):
        merge_apps(ads, apps, vers)


def test_match_job_with_an_empty_side(spark):
    for name, schema, rows in (("no_bids", "fkey_words string, stat_date bigint", []), ("no_searches", "keyword string, stat_date bigint", []),
                               ("some_bids", "fkey_words string, stat_date bigint", [("red", 20240101)]),
                               ("some_searches", "keyword string, stat_date bigint", [("red", 20240102)])):
        spark.createDataFrame(rows, schema).write.mode("overwrite").saveAsTable(name)
    for mode in MODES:
        out = "job_empty_" + mode.replace("-", "_")
        jobs.match_job(spark, mode, 20240101, 20240201, 20240131, "some_bids", "some_searches", out)
        assert spark.table(out).count() == 1
        for bids, searches, sizes in (("no_bids", "some_searches", (0, 1)), ("some_bids", "no_searches", (1, 0)), ("no_bids", "no_searches", (0, 0))):
            _, got = jobs.match_job(spark, mode, 20240101, 20240201, 20240131, bids, searches, out)
            assert (got["bid_words"], got["search_words"]) == sizes
            assert spark.table(out).count() == (mode == "get-data" and searches == "some_searches")


def test_instances_with_an_earlier_days_codes(spark):
    """A second day adds its new categories behind the first day's; scoring with the first day's dictionary knows none of them."""
    from adsift.plans.saved import instances_of_two_days

    profiles = [spark.createDataFrame(rows, "imei string, user_age int, sex string, user_job bigint, marriage_status boolean, "
                                            "mz_apps_car_owner double, user_network_type string")
                for rows in ([("u1", 30, "m", 1, True, 2.0, "4g")], [("u1", 30, "m", 1, True, 2.0, "4g"), ("u2", 20, "f", 2, True, 2.0, None)])]
    apps = [spark.createDataFrame(rows, "appid int, fcategoryid string, fcategory2id string, fevaluate_count int, fdownload_count int, fstars int, "
                                        "finstall_count int, appsize bigint")
            for rows in ([(1, "c2", "x", 1, 1, 1, 1, 1)], [(1, "c2", "x", 1, 1, 1, 1, 1), (2, "c1", "x", 1, 1, 1, 1, 1)])]
    ms = 1704628800000
    events = spark.createDataFrame([(u, a, "e", ms, 2, 20240108) for u in ("u1", "u2") for a in (1, 2)],
                                   "imei string, app_id int, oper_type string, oper_time bigint, tracker_type int, stat_date bigint")
    got = instances_of_two_days(profiles, apps, events, [20240107, 20240108]).collect()
    told = {d: sorted((r["user_age"], r["sex"], r["user_network_type"], r["fcategoryid"]) for r in got if r["codes_day"] == d) for d in (20240107, 20240108)}
    assert told[20240107] == sorted((a, s, n, c) for a, s, n in ((0.0, 0.0, 0.0), (1.0, 1.0, 1.0)) for c in (0.0, 1.0))
    assert told[20240108] == sorted((a, s, n, c) for a, s, n in ((0.0, 0.0, 0.0), (2.0, 2.0, 1.0)) for c in (0.0, 2.0))
