import base64
import gzip
import hashlib
import random

import pytest

from adsift.llm import warc


PAGES = "page_id long, url string, html string, tie string, shard int"


def pages(spark, tmp_path, rows, partitions=3, name="pages"):
    path = str(tmp_path / name)
    spark.createDataFrame([(*r, "clash", 1) for r in rows], PAGES).repartition(partitions).write.parquet(path)
    return spark.read.parquet(path)


def brute(rows, least=0):
    first, out = {}, []
    for page_id, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        known = len(data) >= least and data in first
        out.append((page_id, len(data), digest, "revisit" if known else "response", first[data] if known else None))
        first.setdefault(data, page_id)
    return sorted(out, key=repr)


def read_back(spark, folder):
    out = warc.read(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def made(n=300):
    rng = random.Random(3)
    bodies = ["", None, "<p>é</p>", "<p>a\r\n\r\nb</p>"] + ["x" * rng.randint(0, 400) + str(k) for k in range(60)]
    return [(i * 7919 % 100_003, f"http://h{i % 9}.org/ä b\n{i}" if i % 5 else None, rng.choice(bodies)) for i in range(n)]


def files(folder):
    from pathlib import Path

    return {p.name: p.read_bytes() for p in sorted(Path(folder.removeprefix("file:")).glob("*.gz"))}


def test_roles_digests_and_round_trip(spark, tmp_path):
    rows = made() + [(None, "u", "<p>é</p>"), (None, None, "only here"), (5, "a", "same"), (5, "b", "same"), (5, "b", "same"), (9, "big", "long " * 400_000)]
    folder = str(tmp_path / "archive")
    told = warc.write(pages(spark, tmp_path, rows), folder, shard_bytes=8192, file_bytes=1024).collect()
    assert len(told) > 10 and any(r["roll"] > 0 for r in told) and sum(r["records"] for r in told) == len(rows)
    assert read_back(spark, folder) == brute(rows)
    back = warc.read(spark, folder).collect()
    assert len({r["record_id"] for r in back}) == len(rows)
    ids = {r["record_id"]: r for r in back}
    texts = {}
    for r in back:
        source = ids[r["refers_to_id"]] if r["record_type"] == "revisit" else r
        assert source["record_type"] == "response" and source["payload_digest"] == r["payload_digest"]
        texts.setdefault(r["page_id"], []).append(source["payload"].decode())
    want = {}
    for page_id, _, html in rows:
        want.setdefault(page_id, []).append(html or "")
    assert {k: sorted(v) for k, v in texts.items()} == {k: sorted(v) for k, v in want.items()}
    assert all(r["url"] is None or "\n" not in r["url"] for r in back)


def test_same_files_however_the_input_is_split(spark, tmp_path):
    rows = made()
    seen = []
    for k, (partitions, shuffle) in enumerate([(1, 1), (7, 4), (3, 9)]):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        try:
            folder = str(tmp_path / f"archive-{k}")
            warc.write(pages(spark, tmp_path, rows, partitions, f"pages-{k}"), folder, shard_bytes=6000, file_bytes=900)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        seen.append(files(folder))
    assert len(seen[0]) > 10 and seen[0] == seen[1] == seen[2]
    whole = b"".join(gzip.decompress(x) for x in seen[0].values())
    assert whole.count(b"WARC/1.1\r\n") == len(rows) + len(seen[0])


def test_small_payloads_are_no_revisits(spark, tmp_path):
    rows = [(i, "u", "tiny" if i % 2 else "large enough") for i in range(20)]
    folder = str(tmp_path / "archive")
    warc.write(pages(spark, tmp_path, rows), folder, least_bytes=5)
    assert read_back(spark, folder) == brute(rows, least=5)


def test_no_rows_and_hot_payload(spark, tmp_path):
    folder = str(tmp_path / "none")
    assert warc.write(pages(spark, tmp_path, made(3)).limit(0), folder).collect() == []
    assert warc.read(spark, folder).collect() == []
    rows = [(i, f"http://a/{i}", "one payload") for i in range(500)]
    folder = str(tmp_path / "hot")
    warc.write(pages(spark, tmp_path, rows, 5, "hot-pages"), folder)
    assert read_back(spark, folder) == brute(rows)


def test_damage_is_found(spark, tmp_path):
    folder = str(tmp_path / "archive")
    warc.write(pages(spark, tmp_path, made(20)), folder)
    name, data = next(iter(files(folder).items()))
    for damaged in (data[:-9], data[:200] + bytes([data[200] ^ 1]) + data[201:], data + gzip.compress(b"WARC/1.1\r\n")):
        (tmp_path / "archive" / name).write_bytes(damaged)
        with pytest.raises(Exception, match="."):
            warc.read(spark, folder).collect()
    good = warc.page_record(0, 1, "u", b"payload", None, warc.DATE)
    record = next(warc.members(__import__("io").BytesIO(good)))
    assert warc.parse(record)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(record.replace(b"payload\r\n", b"Payload\r\n"))
    with pytest.raises(ValueError):
        list(warc.members(__import__("io").BytesIO(good[:-5])))
    assert [r["records"] for r in warc.manifest(spark, folder).collect()] == [20]
