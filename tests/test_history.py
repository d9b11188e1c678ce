"""State of all history against full scans, whatever the order of days."""

import random

import pytest

from adsift import jobs
from adsift.plans.saved import tables
from adsift.sources.history import history_state, history_words, update_history
from adsift.sources.tables import bid_words


def frame(spark, words):
    return spark.createDataFrame([(w,) for w in words], "bid_word string")


def plain(days):
    out = {}
    for d, words in days.items():
        for w in words:
            if w is not None:
                first, last = out.get(w, (d, d))
                out[w] = (min(first, d), max(last, d))
    return sorted((w, a, b) for w, (a, b) in out.items())


@pytest.mark.parametrize("seed", [1, 2])
def test_late_and_repeated_days(spark, seed):
    rng, days = random.Random(seed), {}
    with tables(spark) as t:
        for _ in range(7):
            d = 20240101 + rng.randrange(4)
            days[d] = [rng.choice(["a", "b", "c", "", None, "d", "e f"]) for _ in range(rng.randint(0, 4))]
            update_history(spark, frame(spark, days[d]), t["out"], d)
            assert sorted(tuple(r) for r in history_state(spark, t["out"]).collect()) == plain(days)
        log = spark.createDataFrame([(w, d) for d, words in days.items() for w in words] + [("x", 1)], "fkey_words string, stat_date bigint").where("stat_date > 1")
        for s, e in ((0, 0), (0, 20240103), (20240102, 20240104), (20240102, 0)):
            full = sorted(r[0] for r in bid_words(log, s, e).collect())
            assert sorted(r[0] for r in history_words(spark, t["out"], s, e).collect()) == full
        assert spark.table(t["out"]).select("stat_date").distinct().count() <= 2


def test_lost_run_is_repaired_by_running_again(spark, monkeypatch):
    from adsift.sources import history as H

    with tables(spark) as t:
        update_history(spark, frame(spark, ["a", "b"]), t["out"], 1)
        real = H.save_day

        def dies(df, table, dt):
            if table.endswith("_days"):
                raise RuntimeError("lost")
            real(df, table, dt)

        monkeypatch.setattr(H, "save_day", dies)
        with pytest.raises(RuntimeError):
            update_history(spark, frame(spark, ["b", "c"]), t["out"], 1)
        monkeypatch.setattr(H, "save_day", real)
        update_history(spark, frame(spark, ["b", "c"]), t["out"], 1)
        assert sorted(tuple(r) for r in history_state(spark, t["out"]).collect()) == [("b", 1, 1), ("c", 1, 1)]


def test_match_reads_the_state(spark):
    bids = spark.createDataFrame([("red", 20240101), (" red", 20240102), ("ball", 20240102), ("late", 20240109)], "fkey_words string, stat_date bigint")
    searches = spark.createDataFrame([("red ball", 20240103), ("late", 20240104), ("blue", 20240104)], "keyword string, stat_date bigint")
    with tables(spark, bids=bids, searches=searches) as t:
        for d in (20240102, 20240109, 20240101):
            jobs.bid_history_job(spark, t["bids"], d, f"{t['out']}_state")
        by_state = jobs.match_job(spark, "exact-include", 20240101, 20240105, 20240105, t["bids"], t["searches"], f"{t['out']}_a", bid_history=f"{t['out']}_state")
        by_scan = jobs.match_job(spark, "exact-include", 20240101, 20240105, 20240105, t["bids"], t["searches"], f"{t['out']}_b")
        assert by_state[1] == by_scan[1] == {"bid_words": 2, "search_words": 3}
        assert [tuple(r) for r in by_state[0].collect()] == [tuple(r) for r in by_scan[0].collect()] == [("red ball", 1)]
