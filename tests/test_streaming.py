"""Flatten and exact match on streaming sources give the batch results."""

import json

from adsift.operators import adlog as A
from adsift.streaming import adlog_stream as ST


def test_flatten_stream_matches_batch(spark, tmp_path):
    logs = [(json.dumps({"imei": "d%d" % i, "event_content": {"keyword": "k", "ads": [{"app_id": i}, {"app_id": i + 1}]}}),
             20240101 + i % 2) for i in range(6)] + [("not json", 20240101)]
    src = tmp_path / "src"
    spark.createDataFrame(logs, ST.ADLOG_SCHEMA).repartition(3).write.parquet(str(src))
    out = tmp_path / "out"
    q = ST.write_days(ST.flatten_stream(ST.adlog_stream(spark, str(src), max_files_per_trigger=1)),
                      str(out), str(tmp_path / "checkpoint"))
    q.processAllAvailable()
    q.stop()
    again = ST.write_days(ST.flatten_stream(ST.adlog_stream(spark, str(src))), str(out), str(tmp_path / "checkpoint"))
    again.processAllAvailable()  # a restart with the same checkpoint appends nothing twice
    again.stop()
    got = spark.read.parquet(str(out))
    batch = A.flatten_ads(spark.read.parquet(str(src)), keep=["stat_date"])
    assert got.count() == 13
    assert sorted(map(tuple, got.select(*batch.columns).collect())) == sorted(map(tuple, batch.collect()))


def test_exact_match_stream(spark, tmp_path):
    src = tmp_path / "searches"
    spark.createDataFrame([("red", 3), ("blue", 1)], "search_word string, cnt bigint").write.parquet(str(src))
    bids = spark.createDataFrame([("red",)], "bid_word string")
    stream = spark.readStream.schema("search_word string, cnt bigint").parquet(str(src))
    q = (ST.exact_match_stream(stream, bids).writeStream.format("memory").queryName("em_test")
         .outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    assert [tuple(r) for r in spark.table("em_test").collect()] == [("red", 3)]
