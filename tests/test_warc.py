"""Web archives in byte ranges, with broken members, and back from a writer."""

import gzip
import io

import pytest
from pyspark.sql import functions as F

from corpusmill.sources.warc import next_member, ranged, read_warc, write_warc


def record(url, body, kind="response", mime="text/html", extra="", length=None):
    http = f"HTTP/1.1 200 OK\r\nContent-Type: {mime}\r\n{extra}\r\n".encode() + body if kind == "response" else body
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\nWARC-Date: 2026-01-01\r\nContent-Type: application/http\r\nContent-Length: {len(http) if length is None else length}\r\n\r\n"
    return head.encode() + http + b"\r\n\r\n"


def _members():
    out = [gzip.compress(record(f"http://p/{i}", (f"page {i} " * (5 + i * 7 % 90)).encode(), kind="request" if i % 5 == 4 else "response", mime="image/png" if i % 7 == 3 else "text/html; charset=utf-8")) for i in range(60)]
    out[10] = out[10][:20] + bytes(30) + out[10][50:]  # broken in its data
    out[20] = gzip.compress(b"no record at all\r\n\r\n")
    out[30] = gzip.compress(record("http://p/30", b"short", length=9999))
    return out


BROKEN = {10, 20, 30}


@pytest.mark.parametrize("step", [1, 37, 500, 5000, 10**9])
def test_ranges_share_no_record_and_miss_none(step):
    data = b"".join(_members())
    starts = [sum(map(len, _members()[:i])) for i in range(60)]
    found = []
    for at in range(0, len(data), step):
        found += ranged(io.BytesIO(data), at, min(at + step, len(data)))
    good = [r[1] for _, error, r in found if error is None]
    assert good == [f"http://p/{i}" for i in range(60) if i not in BROKEN]
    offsets = [o for o, error, _ in found if error]
    assert set(offsets) <= {starts[i] for i in BROKEN} and len(set(offsets)) == len(offsets)
    if step == 10**9:
        assert offsets == [starts[i] for i in sorted(BROKEN)]


def test_next_member():
    data = b"xx" + b"\x1f\x8b\x08junk" + gzip.compress(b"other") + gzip.compress(record("u", b"x"))
    at = data.rindex(b"\x1f\x8b\x08")
    assert next_member(io.BytesIO(data), 0, len(data)) == at
    assert next_member(io.BytesIO(data), at + 1, len(data)) == len(data) and next_member(io.BytesIO(data), 0, at) == at


def test_data_source(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.warc.gz").write_bytes(b"".join(_members()))
    (tmp_path / "b.warc").write_bytes(record("http://plain", b"p" * 300) + record("http://two", b"q" * 300) + b"WARC/1.0\r\nContent-Length: x\r\n\r\n")
    (tmp_path / "_c.warc").write_bytes(b"hidden")
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    df = read_warc(spark, str(tmp_path), range_bytes=2000)
    assert df.rdd.getNumPartitions() > 3
    rows = df.collect()
    assert sorted(r["url"] for r in rows if r["error"] is None) == sorted([f"http://p/{i}" for i in range(60) if i not in BROKEN] + ["http://plain", "http://two"])
    assert 2 <= sum(r["error"] is not None for r in rows) <= 4 and all(r["body"] is None for r in rows if r["error"])
    html = read_warc(spark, "file://" + str(tmp_path), record_types="response", mime="text/html").where("error IS NULL")
    want = [i for i in range(60) if i not in BROKEN and i % 5 != 4 and i % 7 != 3]
    assert sorted(r["url"] for r in html.where("warc_path = 'a.warc.gz'").collect()) == sorted(f"http://p/{i}" for i in want)
    assert read_warc(spark, str(tmp_path), num_files=1).where("error IS NULL").count() == 2
    one = html.where("url = 'http://p/1'").first()
    assert one["html"].startswith("page 1 ") and one["warc_date"] == "2026-01-01" and bytes(one["body"]) == one["html"].encode()
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        pushed = read_warc(spark, str(tmp_path)).where("record_type = 'request' AND contains(mime, 'http')")
        assert pushed.count() == sum(i % 5 == 4 and i not in BROKEN for i in range(60))
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_codings(spark, tmp_path):
    text = b"<p>coded text</p>" * 20
    chunked = b"%x\r\n%s\r\n0\r\n\r\n" % (len(text), text)
    parts = [record("u1", chunked, extra="Transfer-Encoding: chunked\r\n"), record("u2", gzip.compress(text), extra="Content-Encoding: gzip\r\n"), record("u3", b"\xff\xfeabc"), record("u4", text, extra="Content-Encoding: gzip\r\n")]
    (tmp_path / "x.warc.gz").write_bytes(gzip.compress(b"".join(parts)))  # one member of several records
    found = {r["url"]: r["html"] for r in read_warc(spark, str(tmp_path)).collect()}
    assert found == {"u1": text.decode(), "u2": text.decode(), "u3": "abc", "u4": text.decode()}


def test_written_archives(spark, tmp_path):
    pages = spark.range(100).select(F.concat(F.lit("http://x/"), "id").alias("url"), F.when(F.col("id") != 7, F.repeat(F.concat(F.lit("é"), "id"), 50)).alias("html"), F.lit(1).alias("other"))
    write_warc(pages.repartition(3), str(tmp_path / "out"))
    again = read_warc(spark, str(tmp_path / "out"), range_bytes=1500)
    assert again.rdd.getNumPartitions() >= 6
    assert {(r["url"], r["html"]) for r in again.collect()} == {(r["url"], r["html"] or "") for r in pages.collect()}
    write_warc(pages.limit(5), str(tmp_path / "out"), "overwrite")
    assert read_warc(spark, str(tmp_path / "out")).count() == 5 and not list((tmp_path / "out").glob("_*"))
    failing = pages.select(F.when(F.col("url") == "http://x/50", F.raise_error(F.lit("no"))).otherwise(F.col("url")).alias("url"), "html")
    with pytest.raises(Exception, match="no"):
        write_warc(failing, str(tmp_path / "out"))
    assert read_warc(spark, str(tmp_path / "out")).count() == 5
    with pytest.raises(Exception, match="path|exist|No such"):
        read_warc(spark, str(tmp_path / "missing")).count()
