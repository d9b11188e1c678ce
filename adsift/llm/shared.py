"""Helpers that several operators use."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.strategy import write_table

FILE, ROW = "row_file", "row_index"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, behind whatever path they already have.

    Of use where neither an installation nor shipped files provide it, as in a local session started from another folder.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_row_key(df: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` plus the place of each row: its file and its index there.

    The pair names a row for good, whatever the ids, however rows repeat and
    however a later scan is split. A frame that is no plain file scan is
    written to the shared folder first.
    """
    def keyed(frame: DataFrame) -> DataFrame:
        importable(frame.sparkSession)
        meta = frame.metadataColumn("_metadata")
        return frame.select(*columns, meta["file_path"].alias(FILE), meta["row_index"].alias(ROW))

    try:
        return keyed(df)
    except AnalysisException:
        return keyed(write_table(df, "rows"))


def as_scan(df: DataFrame) -> DataFrame:
    """``df`` if its rows have keys, else its copy in the shared folder."""
    try:
        df.select(df.metadataColumn("_metadata")["row_index"])
        return df
    except AnalysisException:
        return write_table(df, "rows")
