"""The row-wise operators on streaming DataFrames (stream-static).

The reference is batch only. Its flatten (X6) is a projection plus
``explode_outer`` and its exact match (J1) a left-semi join with a static bid
table, so both run unchanged on a ``readStream`` source. Output goes to a
day-partitioned file sink whose commit log gives exactly-once files, as long as
the stream is started again with the same checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.adlog import flatten_ads
from ..operators.matching import exact_match
from ..sources.tables import DAY_COL

ADLOG_SCHEMA = "vcontent string, stat_date bigint"


def adlog_stream(spark: SparkSession, path: str, schema: str = ADLOG_SCHEMA,
                 fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def flatten_stream(logs: DataFrame, col: str = "vcontent") -> DataFrame:
    """Flattened ad rows of a log stream, keeping the day column."""
    keep = [DAY_COL] if DAY_COL in logs.columns else []
    return flatten_ads(logs, col, keep=keep)


def exact_match_stream(searches: DataFrame, bids: DataFrame) -> DataFrame:
    """Search rows of a stream whose keyword is a bid word (static bids)."""
    return exact_match(searches, bids)


def write_days(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Append to a ``stat_date``-partitioned folder. ``checkpoint`` names the
    stream for good: a restart with it goes on where the last run ended."""
    return (stream.writeStream.format(fmt)
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .partitionBy(DAY_COL)
            .outputMode("append")
            .start())
