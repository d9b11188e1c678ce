import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from adsift.session import LIBRARY_CONF, configure

    base = tmp_path_factory.mktemp("spark")
    builder = (SparkSession.builder.master("local[4]").appName("adsift-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.warehouse.dir", str(base / "warehouse"))
               .config("spark.checkpoint.dir", str(base / "checkpoints")))
    for k, v in LIBRARY_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s
    s.stop()
