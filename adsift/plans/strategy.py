"""Size checks before a broadcast, and written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir

DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD_BYTES = 48

FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _bytes_of(column, kind: T.DataType):
    """Bytes of one value; None for a type whose size is not known."""
    if isinstance(kind, FIXED_WIDTH):
        return F.lit(16)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        return F.coalesce(F.octet_length(F.array_join(column, "")) + 16 * F.size(column), F.lit(0))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, FIXED_WIDTH):
        return 16 * F.greatest(F.coalesce(F.size(column), F.lit(0)), F.lit(0))
    return None


def fits_broadcast(table: DataFrame, max_rows: int = DEFAULT_MAX_ROWS, max_bytes: int = DEFAULT_MAX_BYTES) -> bool:
    """Whether a written table is proven small: its rows and bytes, counted by one aggregate over it.

    A column of a type whose size is not known never fits.
    """
    parts = [_bytes_of(F.col(f"`{f.name}`"), f.dataType) for f in table.schema.fields]
    if any(p is None for p in parts):
        return False
    total = sum(parts, F.lit(0))
    row = table.agg(F.count(F.lit(1)).alias("n"), F.sum(total).alias("b")).collect()[0]
    return row["n"] <= max_rows and (row["b"] or 0) + ROW_OVERHEAD_BYTES * row["n"] <= max_bytes


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the session's checkpoint folder
    (shared storage on a cluster) and read it back.

    One job, unlike an eager RDD checkpoint (a count job, then a second job
    that recomputes the plan to write it). The written table cuts lineage,
    survives executor loss, and reads back columnar with column pruning. It
    stays until ``session.drop_scratch``, as lazy results read it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"tables/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
