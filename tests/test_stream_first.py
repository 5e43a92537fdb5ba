"""Duplicates in a stream name the first row, over batches and restarts."""

from datetime import timedelta

import pytest

from corpusmill.streaming.dedup import annotate, start, use_key_state


@pytest.fixture
def store(spark):
    keys = ("spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.noDataMicroBatches.enabled")
    before = {k: spark.conf.get(k) for k in keys}
    use_key_state(spark)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _batch(spark, path, rows):
    spark.createDataFrame(rows, "id long, text string, more string").coalesce(1).write.mode("append").parquet(path)


def _run(spark, tmp_path, ttl=None):
    stream = spark.readStream.schema("id long, text string, more string").parquet(str(tmp_path / "in"))
    start(annotate(stream, ttl=ttl), str(tmp_path / "state"), lambda df, _: df.write.mode("append").parquet(str(tmp_path / "out"))).awaitTermination()
    return {r["id"]: (r["representative_id"], r["more"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}


def test_first_arrivals_over_a_restart(spark, store, tmp_path):
    _batch(spark, str(tmp_path / "in"), [(5, "a  b", "x"), (6, "A b", "y"), (7, "c", None), (8, None, "z")])
    first = _run(spark, tmp_path)
    assert first == {5: (None, "x"), 6: ("5", "y"), 7: (None, None), 8: (None, "z")}
    _batch(spark, str(tmp_path / "in"), [(1, "a b", "later"), (2, "d", ""), (3, "C", ""), (4, "d ", "")])
    both = _run(spark, tmp_path)  # a new query from the same checkpoint
    assert both == first | {1: ("5", "later"), 2: (None, ""), 3: ("7", ""), 4: ("2", "")}


def test_first_arrivals_are_forgotten(spark, store, tmp_path):
    _batch(spark, str(tmp_path / "in"), [(1, "a", "")])
    _run(spark, tmp_path, timedelta(milliseconds=1))
    _batch(spark, str(tmp_path / "in"), [(2, "a", ""), (3, "a", "")])
    assert _run(spark, tmp_path, timedelta(milliseconds=1)) == {1: (None, ""), 2: (None, ""), 3: ("2", "")}
