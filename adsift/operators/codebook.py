"""Category dictionaries that outlive their run (E1, E2, U9): an ML estimator over a catalogue table.

A dictionary grows by days. The first day's values have their ascending ranks
as codes and NULL the code behind them, held in the data or not. A later day
keeps every code there is and numbers the values that it sees first behind the
largest code, ascending. So two days' codes of a common value agree, and a row
can be scored with the dictionary of any earlier day. A value that this one
doesn't hold gets the code of NULL, which never changes.

The table has the columns (feature, value, code) and a partition per day with
what the day added. A day's dictionary is all partitions up to it. Fitting a
day again replaces its partition with the same rows; a day that later ones
build on can't be fitted again, only used.

New values are found by an anti join of a day's different values with the
dictionary and are numbered without passing them through the driver or one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.strategy import fits_broadcast, write_table
from ..sinks.daily import save_day
from ..sources.tables import DAY_COL, in_range
from .features import apply_codes, distinct_values, ranked_values

ENTRY = "feature string, value string, code double"


def new_entries(df: DataFrame, cols: Sequence[str], known: DataFrame | None = None, partitions: int | None = None) -> DataFrame:
    """(feature, value, code) of what ``df`` adds to the dictionary ``known``; the first one holds NULL for every column."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    values = distinct_values(df, cols).where(F.col("value").isNotNull())
    if known is None:
        ranks = write_table(ranked_values(values, n), "code_entries")
        counts = ranks.groupBy("feature").agg(F.count(F.lit(1)).alias("code"))
        # One row per column: a column without a value has NULL alone.
        features = spark.createDataFrame([(c,) for c in cols], "feature string")
        nulls = features.join(counts, "feature", "left").select(
            "feature", F.lit(None).cast("string").alias("value"), F.coalesce("code", F.lit(0)).cast("double").alias("code"))
        return write_table(ranks.select("feature", "value", F.col("rank").cast("double").alias("code")).unionByName(nulls), "code_entries")
    held = known.where(F.col("value").isNotNull()).select("feature", "value")
    fresh = values.join(F.broadcast(held) if fits_broadcast(held) else held, ["feature", "value"], "left_anti")
    # One row per column; a column that is new to the dictionary starts at 0 and has no NULL.
    largest = known.groupBy("feature").agg(F.max("code").alias("largest"))
    numbered = ranked_values(fresh, n).join(F.broadcast(largest), "feature", "left")
    return write_table(numbered.select("feature", "value", (F.col("rank") + F.coalesce(F.col("largest") + 1, F.lit(0.0))).cast("double").alias("code")),
                       "code_entries")


def load_codes(spark: SparkSession, table: str, day: int) -> DataFrame:
    """The dictionary of a day: (feature, value, code)."""
    return spark.table(table).where(F.col(DAY_COL) <= int(day)).select("feature", "value", "code")


class _Coded(HasInputCols):
    table = Param(Params._dummy(), "table", "catalogue table of the dictionary", typeConverter=TypeConverters.toString)
    day = Param(Params._dummy(), "day", "day of the dictionary", typeConverter=TypeConverters.toInt)

    def getTable(self) -> str:
        return self.getOrDefault(self.table)

    def getDay(self) -> int:
        return self.getOrDefault(self.day)


class CategoryCoder(Estimator, _Coded, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the dictionary of a day: what the data adds to the days before, saved in ``table``."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, table: str | None = None, day: int | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> CategoryCoderModel:
        spark, table, day, cols = dataset.sparkSession, self.getTable(), self.getDay(), self.getInputCols()
        known = None
        if spark.catalog.tableExists(table):
            days = spark.table(table).agg(F.max(F.when(F.col(DAY_COL) > day, F.col(DAY_COL))).alias("later"),
                                          F.count_if(F.col(DAY_COL) < day).alias("before")).collect()[0]
            if days["later"] is not None:
                raise ValueError(f"day {day} of {table} can't be fitted again: {days['later']} builds on it")
            if days["before"]:
                known = in_range(spark.table(table), 0, day).select("feature", "value", "code")
        save_day(new_entries(dataset, cols, known), table, day)
        return CategoryCoderModel(inputCols=cols, table=table, day=day)


class CategoryCoderModel(Model, _Coded, DefaultParamsReadable, DefaultParamsWritable):
    """Replaces the input columns by the codes of ``day``. ``save`` and ``load`` keep its parameters; the codes are in the table."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, table: str | None = None, day: int | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def dictionary(self, spark: SparkSession) -> DataFrame:
        return load_codes(spark, self.getTable(), self.getDay())

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return apply_codes(dataset, self.dictionary(dataset.sparkSession), self.getInputCols())
