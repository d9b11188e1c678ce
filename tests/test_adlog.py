"""Flatten and strict extract of JSON ad logs: the five rules and edge rows."""

import json

import pytest

from adsift.operators import adlog as A

DEVICE = {"device_model": "M1", "firmware": "F 1.0", "imei": "dev-1", "ip": "10.0.0.1", "net": "wifi",
          "oper_type": "SEARCH", "operator": "op", "product_type": "APPS", "req_uri": "/s",
          "screen_size": "1x2", "sn": "sn-1", "u_search_id": "s1", "u_session_id": "x1",
          "version_name": "1.0", "oper_time": 1612345678901, "uid": 42, "version_code": 7}


def ad(i, **over):
    a = {"app_id": 100 + i, "display": 1, "kw": "kw%d" % i, "kw_id": 200 + i, "kw_type": 1,
         "request_id": "r%d" % i, "unit_id": 300 + i}
    a.update(over)
    return a


def log(ads=None, drop=(), ec=True, **over):
    d = dict(DEVICE)
    d.update(over)
    for k in drop:
        d.pop(k, None)
    if ec is True:
        e = {"algorithm_version": "v1", "keyword": "kw"}
        if ads is not None:
            e["ads"] = ads
        d["event_content"] = e
    elif ec is not None:
        d["event_content"] = ec
    return json.dumps(d, ensure_ascii=False)


def flat(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, vcontent string")
    rows = A.flatten_ads(df, keep=["id"]).collect()
    return rows


def test_three_sample_shapes(spark):
    # 3 ads / no ads key / 5 ads with operator and uid missing -> 3 + 1 + 5 rows.
    texts = [log([ad(i) for i in range(3)]) + "\t20240203",
             log(None) + "\t20240203",
             log([ad(i) for i in range(5)], drop=("operator", "uid"))]
    rows = flat(spark, texts)
    assert len(rows) == 9
    assert [r["id"] for r in rows].count(1) == 1
    third = [r for r in rows if r["id"] == 2]
    assert all(r["operator"] == "" and r["uid"] == "" for r in third)
    assert {r["app_id"] for r in third} == {str(100 + i) for i in range(5)}
    assert set(rows[0].asDict()) == {"id", *A.FLAT_COLUMNS}
    strict = A.strict_extract(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    assert sorted(r["n_ads"] for r in strict) == [0, 3, 5]


def test_bad_logs_give_one_empty_row(spark):
    texts = ["not json", "", None, "[1, 2]", log(ec=None), log(ec=5), '{"a": 1, "a": 2}']
    rows = flat(spark, texts)
    assert len(rows) == len(texts)
    for r in rows:
        assert all(r[c] == "" for c in A.FLAT_COLUMNS), r


def test_leaf_rules(spark):
    texts = [log([ad(0, kw_type="12", app_id=1.9, kw=5, display=True)], uid="77", version_code=None,
                 imei=123),
             log([]),
             log({"not": "array"}),
             log([ad(0), 7, ad(2)]),
             log([ad(0)]) + " trailing text"]
    rows = flat(spark, texts)
    by = {}
    for r in rows:
        by.setdefault(r["id"], []).append(r)
    r0 = by[0][0]
    assert (r0["kw_type"], r0["app_id"], r0["kw"], r0["display"]) == ("12", "1", "", "")
    assert (r0["uid"], r0["version_code"], r0["imei"]) == ("77", "", "")
    assert len(by[1]) == 1 and by[1][0]["app_id"] == "" and by[1][0]["keyword"] == "kw"
    assert len(by[2]) == 1 and by[2][0]["app_id"] == ""
    assert [r["app_id"] for r in by[3]] == ["100"]
    assert len(by[4]) == 1 and by[4][0]["imei"] == "dev-1"


def test_strict_skips_incomplete_lines(spark):
    texts = [log([ad(0), ad(1)]) + "\t1",
             log([ad(0)], drop=("sn",)) + "\t1",              # required field missing
             log([ad(0), ad(1, kw_id=None), ad(2)]) + "\t1",   # second ad incomplete
             log([ad(0)], ec={"keyword": "k", "ads": []}),     # algorithm_version missing
             log([ad(0)], drop=("operator",)) + "\t1"]          # operator is not required
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, value string")
    got = {r["id"]: r["n_ads"] for r in A.strict_extract(df, keep=["id"]).collect()}
    assert got == {0: 2, 2: 1, 4: 1}


def test_quarantine_accounts_for_every_log(spark):
    good = {f: "x" for f in A.STRICT_DEVICE_FIELDS}
    event = {"algorithm_version": "a", "keyword": "k", "ads": [{"display": 1, "kw_type": 1, "app_id": 2, "kw_id": 3, "unit_id": 4, "kw": "w", "request_id": "r"}]}
    logs = [
        (json.dumps(good | {"event_content": event}), None, None),
        ("oops", ("$", "not_json"), ("$", "not_json")),
        (None, ("$", "not_json"), ("$", "not_json")),
        ("[1]", ("$", "not_object"), ("$", "not_object")),
        (json.dumps(good), ("$.event_content", "missing"), ("$.event_content", "missing")),
        (json.dumps(good | {"event_content": None}), ("$.event_content", "missing"), ("$.event_content", "missing")),
        (json.dumps(good | {"event_content": 3}), ("$.event_content", "not_object"), ("$.event_content", "not_object")),
        (json.dumps(good | {"sn": 5, "imei": None, "event_content": event}), None, ("$.imei", "missing")),
        (json.dumps(good | {"sn": 5, "event_content": event}), None, ("$.sn", "wrong_type")),
        (json.dumps(good | {"event_content": {"algorithm_version": "a"}}), None, ("$.event_content.keyword", "missing")),
        (json.dumps(good | {"event_content": event | {"algorithm_version": [1]}}), None, ("$.event_content.algorithm_version", "wrong_type")),
    ]
    df = spark.createDataFrame([(i, text) for i, (text, *_) in enumerate(logs)], "id int, vcontent string")
    for strict in (False, True):
        taken, rejected, counts = A.quarantined(df, keep=["id"], strict=strict)
        want = {i: told[strict] for i, (_, *told) in enumerate(logs)}
        assert {r["id"]: (r["path"], r["reason"]) for r in rejected.collect()} == {i: w for i, w in want.items() if w}
        assert {r["id"]: r["text"] for r in rejected.collect()} == {i: logs[i][0] for i, w in want.items() if w}
        assert sorted(r["id"] for r in taken.collect()) == [i for i, w in want.items() if not w]
        got = counts.get
        assert got["taken"] == sum(w is None for w in want.values()) and sum(got.values()) == len(logs)
        assert {k: got[k] for k in A.REASONS} == {k: sum(w is not None and w[1] == k for w in want.values()) for k in A.REASONS}
        if strict:
            rows = A.strict_extract(taken, "vcontent", tab_split=False).count()
            assert rows == got["taken"] == A.strict_extract(df, "vcontent", tab_split=False).count()
        else:
            assert A.flatten_ads(taken).where("imei = 'x' or sn = 'x' or ip = 'x'").count() == A.flatten_ads(df).where("ip = 'x'").count()
    with pytest.raises(Exception, match="."):
        A.quarantined(df, "nope")


def test_quarantine_writes_each_log_once(spark):
    """One copy of the text, in no order of verdicts: a write by verdict sorts all logs."""
    df = spark.createDataFrame([(1, "oops\t20240101"), (2, "{}\t20240101")], "id int, line string")
    taken, rejected, _ = A.quarantined(df, "line", ["id"], tab_split=True)
    files = taken.inputFiles()
    assert files and not any("bad=" in f for f in files)
    assert [f.simpleString() for f in spark.read.parquet(*files).schema] == ["log:struct<id:int,line:string>", "fault:struct<path:string,reason:string>"]
    assert sorted(map(tuple, rejected.collect())) == [(1, "oops", "$", "not_json"), (2, "{}", "$.event_content", "missing")]


def test_leading_complete_ads_are_counted(spark):
    good = {f: "x" for f in A.STRICT_DEVICE_FIELDS}
    ad = {"display": 1, "kw_type": 1, "app_id": 2, "kw_id": 3, "unit_id": 4, "kw": "w", "request_id": "r"}
    lists = [([], 0), ([ad], 1), ([ad, ad], 2), ([ad, 0, ad], 1), ([ad | {"kw": 1}, ad], 0), (None, 0), (3, 0)]
    df = spark.createDataFrame([(i, json.dumps(good | {"event_content": {"algorithm_version": "a", "keyword": "k", "ads": ads}}))
                                for i, (ads, _) in enumerate(lists)], "id int, value string")
    assert {r["id"]: r["n_ads"] for r in A.strict_extract(df, keep=["id"]).collect()} == {i: n for i, (_, n) in enumerate(lists)}


def test_logs_are_built_without_shuffling_text(spark, tmp_path, monkeypatch):
    """The counts build the logs once, and no rendered text goes through a shuffle."""
    from datetime import datetime

    from adsift.plans import catalog, fixtures as FX

    day = datetime(1997, 3, 5)
    spark.createDataFrame([(k, k, "O", day, "1-URGENT") for k in range(1, 30)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, n, k, k, "A", "F") for k in range(1, 30) for n in (1, 2)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    plan = FX.adlog(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    built, rows = [], FX.adlog_rows
    monkeypatch.setattr(FX, "adlog_rows", lambda *a: built.append(1) or rows(*a))
    counts = {(r["rules"], r["verdict"]): r["n"] for r in catalog.q_quarantine_counts(spark, str(tmp_path)).collect()}
    assert len(built) == 1
    assert counts["flatten", "taken"] == 29 and counts["strict", "taken"] + counts["strict", "missing"] == 29
