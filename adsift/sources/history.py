"""Distinct words of all history as state.

A job over all history before a day would read every day again. Here each day
is read once: ``update_history`` keeps the day's different words in
``<table>_days`` and merges them into ``<table>``: (bid_word, first_day,
last_day), the first and last day that hold a word. The words before a day are
those whose first day is before it, whatever days were read since.

Days may come late, twice, and with other words than before. A word that a
day has lost is looked up in the kept days only if that day was its first or
last one. The state is written as a new generation before the day's words
replace the old ones, so a run that was lost half-way is repaired by running
the day again. Two generations are kept; a row without a word marks each, as
the words of a generation may be none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.strategy import write_table
from ..sinks.daily import save_day
from .tables import DAY_COL, bid_words, day, in_range

STATE = "bid_word string, first_day bigint, last_day bigint"
GENERATIONS = 2


def _generation(spark: SparkSession, table: str) -> int:
    if not spark.catalog.tableExists(table):
        return 0
    return spark.table(table).agg(F.max(DAY_COL)).collect()[0][0] or 0


def history_state(spark: SparkSession, table: str) -> DataFrame:
    """(bid_word, first_day, last_day) of all days read so far."""
    now = _generation(spark, table)
    if not now:
        return spark.createDataFrame([], STATE)
    return day(spark.table(table), now).where(F.col("bid_word").isNotNull()).drop(DAY_COL)


def history_words(spark: SparkSession, table: str, sdate: int = 0, edate: int = 0) -> DataFrame:
    """(bid_word): as ``bid_words`` of the whole log in [sdate, edate). A range with a first day reads the kept days in it."""
    if sdate:
        return bid_words(spark.table(f"{table}_days"), sdate, edate, "bid_word")
    state = history_state(spark, table)
    return (state.where(F.col("first_day") < int(edate)) if edate else state).select("bid_word")


def update_history(spark: SparkSession, words: DataFrame, table: str, dt: int) -> None:
    """Merge the words (bid_word) of day ``dt``, which replace what the day held before."""
    days = f"{table}_days"
    new = write_table(words.select("bid_word").where(F.col("bid_word").isNotNull()).distinct(), "history-day")
    state, generation = history_state(spark, table), _generation(spark, table)
    merged = [state, new.select("bid_word", F.lit(dt).cast("bigint").alias("first_day"), F.lit(dt).cast("bigint").alias("last_day"))]
    if spark.catalog.tableExists(days):
        kept = spark.table(days)
        edge = (F.col("first_day") == dt) | (F.col("last_day") == dt)
        lost = write_table(day(kept, dt).select("bid_word").join(new, "bid_word", "left_anti")
                           .join(state.where(edge).select("bid_word"), "bid_word", "left_semi"), "history-lost")
        if not lost.isEmpty():
            again = kept.where(F.col(DAY_COL) != dt).join(lost, "bid_word", "left_semi").groupBy("bid_word").agg(
                F.min(DAY_COL).alias("first_day"), F.max(DAY_COL).alias("last_day"))
            merged = [state.join(lost, "bid_word", "left_anti"), merged[1], again]
    rows = merged[0]
    for more in merged[1:]:
        rows = rows.unionByName(more)
    rows = rows.groupBy("bid_word").agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
    mark = spark.createDataFrame([(None, None, None)], STATE)
    save_day(write_table(rows.unionByName(mark), "history-state"), table, generation + 1)
    save_day(new, days, dt)
    if generation + 1 > GENERATIONS:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({DAY_COL} = {generation + 1 - GENERATIONS})")
