"""The jobs end to end on catalogue tables: inputs saved, job run, day read back.

Tables have unique names in the session's warehouse and are dropped again; the
rows read back are kept as an intermediate table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import jobs
from ..operators.codebook import CategoryCoder
from ..operators.matching import MODES, MatchConfig, coverage_of_days, coverage_rollup, prepare
from ..operators.features import event_features
from ..sinks.daily import FEATURE_TYPES, MATCH_SINK_COLUMNS, calendar_days, next_day, save_day, save_range
from ..sources.history import history_state, update_history
from ..sources.tables import DAY_COL, day
from .strategy import write_table


@contextmanager
def tables(spark, **inputs: DataFrame) -> Iterator[dict[str, str]]:
    """Names of catalogue tables with these rows (partitioned by day if they have one); all of the run are dropped after."""
    run = f"adsift_{uuid.uuid4().hex[:12]}"
    names = {k: f"{run}_{k}" for k in inputs}
    try:
        for k, df in inputs.items():
            if DAY_COL in df.columns:
                df.repartition(DAY_COL).write.partitionBy(DAY_COL).saveAsTable(names[k])
            else:
                df.write.saveAsTable(names[k])
        yield names | {"out": f"{run}_out"}
    finally:
        for t in spark.catalog.listTables(pattern=f"{run}*"):
            spark.sql(f"DROP TABLE IF EXISTS {t.name}")


def sink_days(lines: DataFrame) -> DataFrame:
    """Save three days, replace the first, clear the last, read all back by name."""
    spark = lines.sparkSession
    flags = lambda df, c: df.groupBy(F.col(c).alias("word")).agg(F.count(F.lit(1)).alias("cnt"))
    with tables(spark) as t:
        save_day(flags(lines, "l_returnflag"), t["out"], 20240101)
        save_day(flags(lines, "l_linestatus").select("cnt", "word"), t["out"], 20240102)
        save_day(flags(lines, "l_returnflag"), t["out"], 20240103)
        save_day(flags(lines.where("l_quantity > 25"), "l_returnflag").select("cnt", "word"), t["out"], 20240101)
        save_day(flags(lines.where("false"), "l_returnflag"), t["out"], 20240103)
        return write_table(spark.table(t["out"]).select("word", "cnt", DAY_COL), "sink-days")


def match_modes(bids: DataFrame, searches: DataFrame, sdate: int, edate: int, cfg: MatchConfig) -> DataFrame:
    """(mode, search_word, value) of every mode's saved day; both sides are written once for all modes."""
    spark = bids.sparkSession
    with tables(spark, bids=bids, searches=searches) as t:
        found = jobs.match_inputs(spark, sdate, edate, t["bids"], t["searches"])
        sides = prepare(found.searches, found.bids, cfg)
        saved = []
        for mode in MODES:
            out = f"{t['out']}_{mode.replace('-', '_')}"
            jobs.match_job(spark, mode, sdate, edate, edate, t["bids"], t["searches"], out, cfg, found, sides)
            word, value = MATCH_SINK_COLUMNS[mode].values()
            saved.append(day(spark.table(out), edate).select(F.lit(mode).alias("mode"), F.col(word).alias("search_word"), F.col(value).cast("string").alias("value")))
        rows = saved[0]
        for more in saved[1:]:
            rows = rows.unionByName(more)
        return write_table(rows, "match-modes")


def match_counts(bids: DataFrame, searches: DataFrame, sdate: int, edate: int) -> DataFrame:
    """(mode, bid_words, search_words): the sizes that every mode's job reports (A6), without matching."""
    spark = bids.sparkSession
    with tables(spark, bids=bids, searches=searches) as t:
        sizes = jobs.match_inputs(spark, sdate, edate, t["bids"], t["searches"]).sizes
        return spark.createDataFrame([(mode, sizes["bid_words"], sizes["search_words"]) for mode in MODES], "mode string, bid_words bigint, search_words bigint")


def flatten(logs: DataFrame, dt: int) -> DataFrame:
    spark = logs.sparkSession
    with tables(spark, logs=logs) as t:
        jobs.flatten_job(spark, t["logs"], dt, t["out"])
        return write_table(day(spark.table(t["out"]), dt).drop(DAY_COL), "flat-day")


def app_merge(ads: DataFrame, apps: DataFrame, versions: DataFrame, dt: int) -> DataFrame:
    spark = ads.sparkSession
    with tables(spark, ads=ads, apps=apps.withColumn(DAY_COL, F.lit(dt).cast("bigint")), versions=versions) as t:
        jobs.app_merge_job(spark, t["ads"], t["apps"], t["versions"], dt, t["out"])
        return write_table(day(spark.table(t["out"]), dt).drop(DAY_COL), "snapshot-day")


def coverage_days(searches: DataFrame, bids: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Coverage of every day, saved in one job, rolled up from the saved table."""
    spark = searches.sparkSession
    with tables(spark) as t:
        days = write_table(coverage_of_days(searches, bids, cfg), "coverage-days")
        first, last = days.agg(F.min(DAY_COL), F.max(DAY_COL)).collect()[0]
        if first is not None:
            save_range(days, t["out"], first, next_day(last), allowed=(*FEATURE_TYPES, "binary"))
            days = spark.table(t["out"])
        return write_table(coverage_rollup(days), "coverage-rollup")


def instances(profiles: DataFrame, apps: DataFrame, events: DataFrame, dt: int, buckets: int | None = None) -> DataFrame:
    """Training rows of one day, read back from the saved table."""
    spark = profiles.sparkSession
    with tables(spark, profiles=profiles, apps=apps.withColumn(DAY_COL, F.lit(dt).cast("bigint")), events=events) as t:
        jobs.instances_job(spark, t["profiles"], t["apps"], t["events"], dt, t["out"], buckets=buckets)
        return write_table(day(spark.table(f"{t['out']}_instances"), dt).drop(DAY_COL), "instances-day")


def codes_by_day(days: dict[int, DataFrame], cols: list[str]) -> DataFrame:
    """(stat_date, feature, value, code): what each day added to a dictionary, fitted day by day."""
    spark = next(iter(days.values())).sparkSession
    with tables(spark) as t:
        for dt, rows in days.items():
            CategoryCoder(inputCols=cols, table=t["out"], day=dt).fit(rows)
        return write_table(spark.table(t["out"]).select(DAY_COL, "feature", "value", "code"), "codes-by-day")


def instances_of_two_days(profiles: list[DataFrame], apps: list[DataFrame], events: DataFrame, days: list[int]) -> DataFrame:
    """Training rows of the second day, with its own codes and with those of the first (``codes_day``)."""
    spark = events.sparkSession
    both = apps[0].withColumn(DAY_COL, F.lit(days[0]).cast("bigint")).unionByName(apps[1].withColumn(DAY_COL, F.lit(days[1]).cast("bigint")))
    with tables(spark, first=profiles[0], second=profiles[1], apps=both, events=events) as t:
        jobs.instances_job(spark, t["first"], t["apps"], t["events"], days[0], t["out"])
        out = []
        for codes_day in (days[0], None):
            jobs.instances_job(spark, t["second"], t["apps"], t["events"], days[1], t["out"], codes_day)
            rows = day(spark.table(f"{t['out']}_instances"), days[1]).drop(DAY_COL)
            out.append(write_table(rows.withColumn("codes_day", F.lit(codes_day or days[1]).cast("bigint")), "instances-day"))
        return out[0].unionByName(out[1])


def bid_history(runs: list[tuple[int, DataFrame]]) -> DataFrame:
    """(bid_word, first_day, last_day) after these runs of days, in this order."""
    spark = runs[0][1].sparkSession
    with tables(spark) as t:
        for dt, words in runs:
            update_history(spark, words, t["out"], dt)
        return write_table(history_state(spark, t["out"]), "bid-history")


def backfill(events: DataFrame, sdate: int, edate: int, zone: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, manifest) of event features of all days of a range, saved in one job over days that were there before."""
    spark = events.sparkSession
    rows = event_features(events, keep=(DAY_COL,), zone=zone)
    with tables(spark) as t:
        for d in calendar_days(sdate, edate)[-2:]:    # replaced, or emptied
            save_day(rows.limit(3), t["out"], d)
        told = write_table(save_range(rows, t["out"], sdate, edate), "backfill-manifest")
        return write_table(spark.table(t["out"]), "backfill-rows"), told
