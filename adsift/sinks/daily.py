"""Day-partitioned table sink (K1-K7).

``save_day`` derives the column list from the DataFrame, creates the table
if missing (partitioned by ``stat_date BIGINT``) and replaces exactly one day
with a static-partition ``INSERT OVERWRITE``: re-running a day replaces it,
other days stay, and an empty result empties the day. Columns go by name; a
missing or extra column, or one of another type than the table's, is an error.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.strategy import write_table
from ..sources.tables import DAY_COL

FEATURE_TYPES = ("int", "bigint", "string", "boolean", "double")   # K1
SNAPSHOT_TYPES = ("int", "bigint", "string")                       # K2

# Fixed output schemas of the matching jobs (column renames at the sink).
MATCH_SINK_COLUMNS = {
    "exact-match": {"search_word": "keyword", "cnt": "cnt"},
    "exact-include": {"search_word": "search_word", "cnt": "cnt"},
    "syno-include": {"search_word": "search_word", "cnt": "cnt"},
    "core-include": {"search_word": "search_word", "cnt": "cnt"},
    "get-data": {"search_word": "search_word", "bidlist": "bidlist"},
}


def ddl_columns(df: DataFrame, allowed: Sequence[str] = FEATURE_TYPES) -> list[tuple[str, str]]:
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        if t not in allowed:
            raise TypeError(f"column {f.name!r} has type {t}; the sink takes {', '.join(allowed)}")
        out.append((f.name, t))
    return out


def save_day(df: DataFrame, table: str, dt: int, allowed: Sequence[str] = FEATURE_TYPES,
             rename: Mapping[str, str] | None = None, fmt: str = "parquet", bucket: tuple[str, int] | None = None) -> None:
    """Create ``table`` if missing and overwrite its ``stat_date = dt`` day.

    ``bucket`` (column, number) makes a table of sorted buckets, one file each a
    day: tables of as many buckets by the same column are joined without a shuffle.
    """
    spark = df.sparkSession
    if rename:
        df = df.select(*[F.col(src).alias(dst) for src, dst in rename.items()])
    if DAY_COL in df.columns:
        df = df.drop(DAY_COL)
    cols = ddl_columns(df, allowed)
    col_sql = ", ".join(f"`{n}` {t}" for n, t in cols)
    by = f" CLUSTERED BY (`{bucket[0]}`) SORTED BY (`{bucket[0]}`) INTO {int(bucket[1])} BUCKETS" if bucket else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({col_sql}, {DAY_COL} BIGINT) "
              f"USING {fmt} PARTITIONED BY ({DAY_COL}){by}")
    there = [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema.fields if f.name != DAY_COL]
    if sorted(there) != sorted(cols):
        raise ValueError(f"columns {cols} do not fit table {table} with {there}")
    if bucket:    # a task for each bucket
        df = df.repartition(int(bucket[1]), bucket[0])
    view = f"adsift_sink_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        names = ", ".join(f"`{n}`" for n, _ in there)
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({DAY_COL} = {int(dt)}) "
                  f"SELECT {names} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def calendar_days(sdate: int, edate: int) -> list[int]:
    """The days of [sdate, edate) as numbers."""
    first, end = (datetime.strptime(str(d), "%Y%m%d") for d in (sdate, edate))
    return [int((first + timedelta(days=k)).strftime("%Y%m%d")) for k in range((end - first).days)]


def next_day(dt: int) -> int:
    return int((datetime.strptime(str(dt), "%Y%m%d") + timedelta(days=1)).strftime("%Y%m%d"))


def save_range(df: DataFrame, table: str, sdate: int, edate: int, allowed: Sequence[str] = FEATURE_TYPES, fmt: str = "parquet") -> DataFrame:
    """Replace all days of [sdate, edate) in one job; returns the manifest (stat_date, rows).

    ``df`` has a day column; a row of another day is an error. Every day of
    the range ends as if it had been saved alone: days with rows are replaced
    by a dynamic partition overwrite, days without are emptied. Rows are
    rebalanced by day first, so that small days make one file and large ones
    several of a good size. ``<table>_manifest`` has one row per saved day with
    its number of rows, so an empty day and a day that never ran differ.
    """
    spark, days = df.sparkSession, calendar_days(sdate, edate)
    cols = ddl_columns(df.drop(DAY_COL), allowed)
    rows = write_table(df.withColumn(DAY_COL, F.col(DAY_COL).cast("bigint")), "range-rows")
    counts = {r[DAY_COL]: r["n"] for r in rows.where(F.col(DAY_COL).isin(days)).groupBy(DAY_COL).agg(F.count(F.lit(1)).alias("n")).collect()}
    if sum(counts.values()) != rows.count():
        raise ValueError(f"rows outside of [{sdate}, {edate})")
    col_sql = ", ".join(f"`{n}` {t}" for n, t in cols)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({col_sql}, {DAY_COL} BIGINT) USING {fmt} PARTITIONED BY ({DAY_COL})")
    there = [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema.fields if f.name != DAY_COL]
    if sorted(there) != sorted(cols):
        raise ValueError(f"columns {cols} do not fit table {table} with {there}")
    ordered = rows.select(*[F.col(f"`{n}`") for n, _ in there], DAY_COL)
    _overwrite_days(ordered.hint("rebalance", DAY_COL), table)
    held = {int(r[0].split("=")[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}    # days of the table
    empty = [f"PARTITION ({DAY_COL} = {d})" for d in days if d in held and d not in counts]
    if empty:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(empty)}")
    told = spark.createDataFrame([(d, counts.get(d, 0)) for d in days], f"{DAY_COL} bigint, rows bigint")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table}_manifest ({DAY_COL} BIGINT, rows BIGINT) USING {fmt}")
    others = spark.table(f"{table}_manifest").where((F.col(DAY_COL) < sdate) | (F.col(DAY_COL) >= edate))
    write_table(others.unionByName(told), "range-manifest").coalesce(1).write.insertInto(f"{table}_manifest", overwrite=True)
    return spark.table(f"{table}_manifest").where((F.col(DAY_COL) >= sdate) & (F.col(DAY_COL) < edate))


def _overwrite_days(df: DataFrame, table: str) -> None:
    """Replace the days that ``df`` has rows of; its columns are in the table's order."""
    spark, key = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        df.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(key, before)


def save_match(df: DataFrame, mode: str, table: str, dt: int) -> None:
    """Fixed-schema sinks of the matching modes (K3-K5)."""
    save_day(df, table, dt, rename=MATCH_SINK_COLUMNS[mode])
