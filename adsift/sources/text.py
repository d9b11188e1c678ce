"""Text files with a per-file charset choice.

A file is read as UTF-8 when every line of it is valid UTF-8, otherwise the
whole file is decoded as GBK (cp936). The vote is per file, not per line:
GBK bytes can form valid UTF-8 by chance, so one line alone can't tell.

Lines keep their raw bytes (the text source does not re-encode). The vote is an
aggregate over (file, bytes), combined map-side; only the names of files with a
line that is not UTF-8 are joined back, and AQE splits one huge file's lines.

Decoding as GBK needs ``spark.sql.legacy.javaCharsets``, which
``session.configure`` sets where the session does not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FALLBACK_CHARSET = "GBK"


def decode_by_vote(lines: DataFrame, file_col: str = "file", bytes_col: str = "value",
                   fallback: str = FALLBACK_CHARSET) -> DataFrame:
    """(file, bytes) rows -> (file string, value string, charset string)."""
    raw = lines.select(F.col(file_col).alias("file"), F.col(bytes_col).cast("binary").alias("raw"))
    text = F.col("raw").cast("string")
    other = (raw.where(~F.is_valid_utf8(text)).groupBy("file").agg(F.lit(True).alias("other"))
             .withColumnRenamed("file", "voted"))
    voted = raw.join(other, F.col("file") == F.col("voted"), "left")
    return voted.select(
        "file", F.when(F.col("other"), F.decode(F.col("raw"), fallback)).otherwise(text).alias("value"),
        F.when(F.col("other"), F.lit(fallback)).otherwise(F.lit("UTF-8")).alias("charset"))


def read_text_detect(spark: SparkSession, paths: str | list[str], fallback: str = FALLBACK_CHARSET) -> DataFrame:
    """Text files -> (file string, value string, charset string)."""
    text = spark.read.text(paths)
    return decode_by_vote(text.select(F.col("_metadata.file_path").alias("file"), "value"), fallback=fallback)
