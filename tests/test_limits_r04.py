"""Findings of round 4: what one task holds or reads is bounded, whatever the input."""

import pyarrow as pa
import pyarrow.parquet as pq

from corpusmill import queries


def test_images_leave_a_task_in_small_batches(spark):
    """F4 to F10."""
    rows = pa.RecordBatch.from_pydict({"vec_id": list(range(40)), "embedding": [[0.01 * k] * 64 for k in range(40)]})
    made = list(queries._drawings([rows]))
    assert max(b.num_rows for b in made) <= 16 and [i for b in made for i in b["id"].to_pylist()] == list(range(40))
    plan = queries.image_metadata(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("ArrowEvalPython") == 1


def test_stream_files_follow_the_input(spark, tmp_path, monkeypatch):
    """nine files of documents become as many files in each of three parts, and none is read by one task alone."""
    docs = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    (tmp_path / "documents.parquet").mkdir()
    for k in range(9):
        pq.write_table(docs.slice(k * 22, 22 if k < 8 else None), tmp_path / "documents.parquet" / f"{k}.parquet")
    monkeypatch.setattr(queries, "_scratch", lambda spark: str(tmp_path))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # each file is a split
    try:
        out = queries.streaming_representatives(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert len(list((tmp_path / "in").rglob("*.parquet"))) > 20
    assert len(list((tmp_path / "state" / "commits").glob("[0-9]*"))) >= 3
    assert sum(r["members"] for r in out) == 200 and all(r["firsts"] == 1 and r["named"] for r in out)
