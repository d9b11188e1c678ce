"""Per-file charset vote: UTF-8 file, and a GBK file with a line valid as UTF-8."""

from adsift.sources.text import decode_by_vote, read_text_detect


def test_charset_vote(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("山水\t1\nplain\n".encode())
    # The first line's GBK bytes are valid UTF-8 on their own.
    assert "一".encode("gbk").decode() != "一"
    (tmp_path / "b.txt").write_bytes("一\n日月星\t2\n".encode("gbk"))
    for i in range(3):
        (tmp_path / f"u{i}.txt").write_bytes(b"line\n")
    df = read_text_detect(spark, str(tmp_path))
    rows = {(r["file"].rsplit("/", 1)[-1], r["value"], r["charset"]) for r in df.collect()}
    assert rows == {("a.txt", "山水\t1", "UTF-8"), ("a.txt", "plain", "UTF-8"),
                    ("b.txt", "一", "GBK"), ("b.txt", "日月星\t2", "GBK"), *((f"u{i}.txt", "line", "UTF-8") for i in range(3))}


def test_vote_over_rows(spark):
    """Any (file, bytes) rows; a file held by a third of the rows; no rows."""
    rows = [("u", "é".encode())] * 300 + [("g", "日".encode("gbk")), ("g", b"plain"), ("n", None), (None, b"x")]
    df = decode_by_vote(spark.createDataFrame(rows, "file string, value binary"))
    got = {(r["file"], r["value"], r["charset"]) for r in df.collect()}
    assert got == {("u", "é", "UTF-8"), ("g", "日", "GBK"), ("g", "plain", "GBK"), ("n", None, "UTF-8"), (None, "x", "UTF-8")}
    assert df.count() == 304
    assert decode_by_vote(spark.createDataFrame([], "file string, value binary")).count() == 0
