"""Operators against plain Python definitions, on rows with nulls, odd spaces, ports, users and mixed case."""

import random
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import records, text, url
from corpusmill.operators import Combined, ImageQualityFilter, TextExactDeduplicator, TextLengthFilter, UrlFilter
from corpusmill.operators.base import DETAILS, passed, rejected

URLS = [None, "", "https://www.casino-win.example.org/en/14", "https://m.adult-x.example.net/fr/780", "http://a.com/webcam", "http://a.com/buy-now", "http://a.com/XXX/porn", "http://sussex.ac.uk/", "a.com/x", "http://a.b.com:8080/x", "https://u:p@h.org/a", "HTTP://A.com/x", "//x.com", "http:///p", "http://x.spam.com/1", "http://spam.com", "http://nospam.com", "https://en.wikipedia.org/wiki/X"]


def _score(address):
    best, total, at = 0.0, 0.0, 0
    words = sorted(url.WORD_WEIGHTS, key=lambda w: (-len(w), w))
    low = address.lower()
    while at < len(low):
        hit = next((w for w in words if low.startswith(w, at)), None)
        if hit:
            best, total = max(best, url.WORD_WEIGHTS[hit]), total + url.WORD_WEIGHTS[hit]
        at += len(hit) if hit else 1
    return min(1.0, best * 0.8 + min(total / 3.0, 0.2)) if best else 0.0


def _host(address):
    full = address if address.startswith(("http://", "https://")) else "http://" + address
    return urlparse(full).netloc.lower() or None


def test_url_parts(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "i int, url string")
    got = df.select("i", url.domain(F.col("url")).alias("d"), url.word_score(F.col("url"), url.WORD_WEIGHTS).alias("s")).collect()
    for r in got:
        u = URLS[r["i"]]
        if u:
            assert r["d"] == _host(u), u
            assert r["s"] == pytest.approx(_score(u)), u


@pytest.mark.parametrize("many", [False, True])
def test_url_filter(spark, many):
    blocked = [f"b{i}.example" for i in range(2500)] if many else []
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "id int, url string")
    op = UrlFilter(blocklist_domains=["Spam.com ", *blocked], exclude_quality_sources=True)
    kept = {r["id"] for r in op.transform(df).collect()}
    want = set()
    for i, u in enumerate(URLS):
        host = _host(u) if u else None
        parents = {".".join(host.split(".")[j:]) for j in range(host.count(".") + 1)} if host else set()
        if not u or not ("spam.com" in parents or _score(u) >= 0.5 or parents & set(url.QUALITY_SOURCES)):
            want.add(i)
    assert kept == want
    both = op.annotate(df)
    assert {r["id"] for r in passed(both).collect()} == want
    assert rejected(both).count() == len(URLS) - len(want)


def test_url_filter_reads_a_blocklist(spark, tmp_path):
    (tmp_path / "list.txt").write_text("# note\n\n A.com \n")
    df = spark.createDataFrame([("http://x.a.com/",), ("http://b.com/",)], "url string")
    assert [r["url"] for r in UrlFilter(blocklist_paths=[str(tmp_path / "list.txt")]).transform(df).collect()] == ["http://b.com/"]
    with pytest.warns(UserWarning):
        UrlFilter(blocklist_paths=[str(tmp_path / "none.txt")])


def test_text_length(spark):
    op = TextLengthFilter(3, 5)
    keep = lambda df: [r["i"] for r in op.transform(df).orderBy("i").collect()]
    plain = spark.createDataFrame([(1, "abc"), (2, "été"), (3, "abcdef"), (4, None), (5, "")], "i int, text string")
    assert keep(plain) == [1, 2]
    known = spark.createDataFrame([(1, "abcdef", 4.9), (2, "abc", None), (3, "abc", 9.0)], "i int, text string, text_length double")
    assert keep(known) == [1, 2]
    assert keep(plain.withColumn("text_length", F.lit("9"))) == [1, 2]
    assert keep(spark.createDataFrame([(1, bytearray(b"abcd")), (2, bytearray(b"ab"))], "i int, text binary")) == [1]
    assert keep(plain.select("i")) == []


def test_exact_dedup_edges(spark):
    rows = [(1, "Hello   World\n"), (2, "hello world"), (3, "hello world"), (4, "hello\u001cworld"), (5, "hello​world"), (6, None), (7, "   "), (8, "\t")]
    df = spark.createDataFrame(rows, "id long, text string")
    op = TextExactDeduplicator()
    assert sorted(r["id"] for r in op.transform(df).collect()) == [1, 5, 6, 7]
    got = {r["id"]: r[DETAILS] for r in op.annotate(df).collect()}
    assert {i: d["representative_id"] for i, d in got.items() if d} == {2: "1", 3: "1", 4: "1", 8: "7"}
    assert got[2]["reason"] == "duplicate" and got[2]["operator"] == "TextExactDeduplicator"


def test_exact_dedup_is_stable(spark):
    rng = random.Random(4)
    words = ["a", "B", " b", " c", None, ""]
    rows = [(i, None if rng.random() < 0.1 else " ".join(rng.choice(words) or "" for _ in range(3))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, text string")
    seen, want = set(), []
    for i, t in rows:
        key = " ".join(t.split()).lower() if t else ("id", i)
        if key not in seen:
            seen.add(key)
            want.append(i)
    for parts in (1, 3, 7):
        once = TextExactDeduplicator().transform(df.repartition(parts))
        assert sorted(r["id"] for r in once.collect()) == want
        assert TextExactDeduplicator().transform(once).count() == len(want)
        assert passed(TextExactDeduplicator().annotate(df.repartition(parts))).count() == len(want)


def test_rejections_add_up_and_need_no_python(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    both = Combined([TextLengthFilter(100), TextExactDeduplicator()]).annotate(df)
    assert both.count() == df.count()
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "Window" not in plan


def test_missing_columns_are_an_error(spark):
    with pytest.raises(ValueError, match="needs the columns"):
        UrlFilter().transform(spark.range(1))


def test_image_quality_filter_edges(spark):
    rows = [(1, 256, 256, 0.8, 3.0), (2, 255, 256, 0.0, 5.0), (3, 256, 256, 0.8001, 3.0), (4, 256, 256, 0.1, 2.999), (5, None, None, None, None)]
    df = spark.createDataFrame(rows, "id int, image_width int, image_height int, image_compression_artifacts float, image_information_entropy float")
    assert [r["id"] for r in ImageQualityFilter().transform(df).collect()] == [1]
    assert ImageQualityFilter().transform(df.select("id")).count() == 0


def test_partition_keys(spark):
    df = spark.createDataFrame([('{"a": {"b": "Url Filter/1"}}', ("é x",)), ("no json", (None,)), (None, ("",))], "j string, s struct<v:string>")
    got = df.select(records.partition_key(df, "j.a.b").alias("j"), records.partition_key(df, "s.v").alias("s"), records.partition_key(df, "none").alias("n")).collect()
    assert [tuple(r) for r in got] == [("Url_Filter_1", "é_x", "unknown"), ("unknown", "unknown", "unknown"), ("unknown", "unknown", "unknown")]


def test_formats(spark):
    value = F.lit(1234.5678)
    shown = spark.range(1).select(*(records.formatted(value, k).alias(k) for k in ("percent", "time", "latency", "number", "integer")), records.formatted(F.lit(None).cast("double"), "time").alias("none")).first()
    assert tuple(shown) == ("1234.57%", "1234.57s", "1234567.80ms", "1,234.57", "1,234", "N/A")


def test_normal_form_is_that_of_python(spark):
    rows = [("".join(chr(c) for c in range(a, a + 64)),) for a in range(1, 0x3100, 64)]
    df = spark.createDataFrame(rows, "t string").select("t", text.normalize(F.col("t"), lowercase=False).alias("n"))
    assert all(r["n"] == " ".join(r["t"].split()) for r in df.collect())
