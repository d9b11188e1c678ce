"""Day-partitioned table scans.

A "day" is ``stat_date BIGINT`` holding yyyymmdd. Every function returns a
lazy DataFrame whose predicates sit directly above the scan, so partition
pruning and Parquet filter pushdown apply.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY_COL = "stat_date"


def read_parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def day_number(ts: Column) -> Column:
    """Timestamp/date -> yyyymmdd as BIGINT (the partition value format)."""
    return F.date_format(ts, "yyyyMMdd").cast("bigint")


def date_range(sdate: int = 0, edate: int = 0, col: str = DAY_COL) -> Column:
    """Half-open day range ``[sdate, edate)``; 0 leaves that side open.

    ``(0, 0)`` gives an always-true predicate, which Catalyst folds away.
    """
    cond = F.lit(True)
    if sdate:
        cond = cond & (F.col(col) >= F.lit(int(sdate)))
    if edate:
        cond = cond & (F.col(col) < F.lit(int(edate)))
    return cond


def day(df: DataFrame, dt: int, col: str = DAY_COL) -> DataFrame:
    """One day of a partitioned table, all columns."""
    return df.where(F.col(col) == F.lit(int(dt)))


def day_columns(df: DataFrame, dt: int, columns: Sequence[str], col: str = DAY_COL) -> DataFrame:
    """One day, chosen columns."""
    return day(df, dt, col).select(*columns)


def in_range(df: DataFrame, sdate: int = 0, edate: int = 0, col: str = DAY_COL) -> DataFrame:
    if not sdate and not edate:
        return df
    return df.where(date_range(sdate, edate, col))


def bid_words(df: DataFrame, sdate: int = 0, edate: int = 0, keyword_col: str = "fkey_words") -> DataFrame:
    """Distinct trimmed bid keywords; NULL dropped, empty string kept.

    -> ``(bid_word string)``
    """
    word = F.trim(F.col(keyword_col))
    return (in_range(df, sdate, edate)
            .select(word.alias("bid_word"))
            .where(F.col("bid_word").isNotNull())
            .distinct())


def search_words(df: DataFrame, sdate: int = 0, edate: int = 0, keyword_col: str = "keyword") -> DataFrame:
    """Trimmed search keyword with its number of log rows in the range.

    -> ``(search_word string, cnt bigint)``; partial counts are combined map-side,
    so a keyword holding a large share of the log costs one row per task.
    """
    word = F.trim(F.col(keyword_col))
    return (in_range(df, sdate, edate)
            .select(word.alias("search_word"))
            .where(F.col("search_word").isNotNull())
            .groupBy("search_word")
            .agg(F.count(F.lit(1)).alias("cnt")))


def distinct_ids(df: DataFrame, id_col: str, alias: str) -> DataFrame:
    """``select distinct(id) as alias`` (A2)."""
    return df.select(F.col(id_col).alias(alias)).distinct()


def max_by_key(df: DataFrame, key_col: str, value_col: str, key_alias: str, value_alias: str) -> DataFrame:
    """``select key as k, max(v) as m group by key`` (A5)."""
    return df.groupBy(F.col(key_col).alias(key_alias)).agg(F.max(value_col).alias(value_alias))
