"""Mergeable samples against plain ranks."""

import hashlib

import pytest

from adsift.operators import features as FE
from adsift.operators import sampling as SM


def hashed(key, seed="sample-1"):
    return (int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:13], 16) + 1) / 2.0**52


def plain(rows, k):
    """rows: (key, stratum, weight) -> {key: sample weight}"""
    out = {}
    for stratum in {r[1] for r in rows}:
        ranked = sorted((hashed(key) / w, key, w) for key, s, w in {*rows} if s == stratum and key is not None and w and w > 0)
        threshold = ranked[k][0] if len(ranked) > k else None
        out |= {key: float(w) if threshold is None else max(w, 1 / threshold) for _, key, w in ranked[:k]}
    return out


ROWS = [(i, "abc"[i % 3] if i % 7 else None, 1 + i % 5) for i in range(400)] + [(900, "rare", 2), (901, "zero", 0), (902, "null", None), (None, "a", 1)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "id int, s string, w int")


@pytest.mark.parametrize("k", [1, 10, 1000])
def test_union_of_samples_is_the_sample_of_the_union(spark, k):
    want = plain(ROWS, k)
    whole = SM.sample(frame(spark), "id", k, ["s"], "w")
    assert {r["id"]: r["sample_weight"] for r in SM.finished(whole, "id", k, ["s"], "w").collect()} == pytest.approx(want)
    parts = [SM.sample(frame(spark, ROWS[a:b]), "id", k, ["s"], "w") for a, b in ((0, 150), (100, 320), (300, None))]    # overlapping
    both = SM.merged([SM.merged(parts[:2], "id", k, ["s"]), parts[2]], "id", k, ["s"])
    assert {r["id"]: r["sample_weight"] for r in SM.finished(both, "id", k, ["s"], "w").collect()} == pytest.approx(want)


def test_weights_estimate_the_whole(spark):
    df = spark.range(0, 20000).selectExpr("cast(id as int) as id", "'x' as s", "cast(1 + id % 9 as int) as w")
    got = SM.finished(SM.sample(df, "id", 800, ["s"], "w"), "id", 800, ["s"], "w")
    total, real = got.agg({"sample_weight": "sum"}).first()[0], df.agg({"w": "sum"}).first()[0]
    assert got.count() == 800 and abs(total / real - 1) < 0.1


def test_latest_version_of_a_key(spark):
    df = spark.createDataFrame([(1, 5, "old"), (1, 9, "new"), (1, 9, "new"), (2, 1, "only")], "id int, day int, v string")
    got = SM.finished(SM.sample(df, "id", 5, version="day"), "id", 5)
    assert sorted((r["id"], r["v"]) for r in got.collect()) == [(1, "new"), (2, "only")]
    assert SM.finished(SM.sample(df.limit(0), "id", 5), "id", 5).collect() == []


def test_features_of_a_sample_have_the_codes_of_all(spark):
    df = spark.range(0, 300).selectExpr(
        "cast(id as string) as imei", "cast(id % 50 as int) as user_age", "if(id % 2 = 0, 'm', 'f') as sex", "id % 7 as user_job",
        "true as marriage_status", "0.5D as mz_apps_car_owner", "cast(null as string) as user_network_type")
    taken = {r["imei"]: r for r in FE.sampled_profile_features(df, 20, ["sex"]).collect()}
    whole = {r["imei"]: r for r in FE.profile_features(df).collect()}
    assert len(taken) == 40
    assert all(whole[i][c] == r[c] for i, r in taken.items() for c in FE.PROFILE_COLUMNS)
