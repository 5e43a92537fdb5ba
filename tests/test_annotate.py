"""Marks of duplicates with one key of half of all rows, repeated rows, maps and rows rejected before."""

import random
import re

from pyspark.sql import functions as F

from corpusmill.operators import Combined, SemanticDeduplicator, TextExactDeduplicator, TextLengthFilter, base
from corpusmill.operators.base import DETAILS
from corpusmill.queries import QUERIES


def _rows():
    rng = random.Random(8)
    out = [(i, rng.choice(["hot key"] * 10 + [f"text number {rng.randrange(40)}"] * 9 + ["no"]), {"a": i % 3}) for i in range(600)]
    return out + [out[0], out[0], out[7], (None, "hot key", {"a": 1}), (None, None, None), (1000, None, {})]


def _plain(rows):
    """(id, text, representative, or '' for what stays) by a loop."""
    first, out = {}, []
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        if t is None or len(t) < 3:
            out.append((i, t, "short"))
            continue
        if t in first:
            out.append((i, t, first[t]))
        else:
            first[t] = str(i)
            out.append((i, t, ""))
    return sorted(map(repr, out))


def test_marks(spark, monkeypatch):
    df = spark.createDataFrame(_rows(), "id long, text string, tags map<string,int>").repartition(5)
    ops = Combined([TextLengthFilter(3, 100), TextExactDeduplicator()])
    for heavy, chunk, broadcast in ((1000, 10**6, "10485760"), (1, 1, "-1"), (3, 2, "-1")):
        monkeypatch.setattr(base, "HEAVY", heavy)
        monkeypatch.setattr(base, "CHUNK", chunk)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        try:
            got = ops.annotate(df).collect()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got[0].__fields__ == ["id", "text", "tags", DETAILS]
        told = sorted(repr((r["id"], r["text"], "" if r[DETAILS] is None else "short" if r[DETAILS]["reason"] == "filtered" else r[DETAILS]["representative_id"])) for r in got)
        assert told == _plain(_rows())
        assert all(r[DETAILS]["dedup_key"] for r in got if r[DETAILS] and r[DETAILS]["reason"] == "duplicate")
        assert sorted((r["id"] or -1, r["tags"] and r["tags"].get("a")) for r in got if r["tags"]) == sorted((i or -1, t.get("a")) for i, _, t in _rows() if t)
    assert ops.annotate(df.limit(0)).count() == 0


def test_no_window_and_no_key_in_one_task(spark):
    df = QUERIES["dedup_rejected_with_representative"](spark, "/root/testdata/sf0.001")
    assert not re.search(r"\bWindow\b", df._jdf.queryExecution().executedPlan().toString())


def test_rows_of_a_heavy_key_are_spread(spark, monkeypatch):
    monkeypatch.setattr(base, "HEAVY", 5)
    df = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 500)).alias("text"))
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        out = TextExactDeduplicator().annotate(df).where(f"{DETAILS}.representative_id = '0'").withColumn("task", F.spark_partition_id())
        counts = [r["count"] for r in out.groupBy("task").count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(counts) == 1999 and len(counts) == 8 and max(counts) < 500


def test_semantic_duplicates_with_maps(spark):
    df = spark.createDataFrame([(1, 0, [1.0, 0.0], {"a": 1}), (2, 0, [1.0, 0.01], {"b": 2}), (3, 0, [0.0, 1.0], None)], "id long, cluster int, embedding array<double>, tags map<string,int>")
    assert sorted(r["id"] for r in SemanticDeduplicator().transform(df).collect()) == [1, 3]
