"""Settings of the session win, and only a local session may go without a shared folder."""

import pytest
from pyspark.sql import functions as F

from adsift import session
from adsift.plans.strategy import fits_broadcast, write_table


def test_given_settings_stay(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        session.configure(spark)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


class Bare:
    """A session on a cluster that names no shared folder."""

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

        @staticmethod
        def getConf():
            return {}

    conf = {}


def test_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Bare)


def test_proven_small(spark):
    df = write_table(spark.range(100).select("id", F.lit("x" * 100).alias("s"), F.array(F.lit("ab")).alias("a")), "t")
    assert fits_broadcast(df) and not fits_broadcast(df, max_rows=99) and not fits_broadcast(df, max_bytes=9000)
    assert not fits_broadcast(write_table(df.select(F.create_map("id", "s").alias("m")), "t"))
    assert fits_broadcast(df.limit(0))
