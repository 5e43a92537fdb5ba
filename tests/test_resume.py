"""Loading that was stopped goes on, and each row is there once."""

import pytest
from pyspark.sql import functions as F

from corpusmill.plans.config import configuration
from corpusmill.plans.runner import Pipeline
from corpusmill.sources.loaders import DatasetLoader
from corpusmill.sources.resume import batches_done, files_of, load_once


def test_a_killed_load_goes_on(spark, tmp_path):
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    spark.range(100).withColumn("text", F.concat(F.lit("t"), "id")).repartition(5).write.json(source)
    loader = DatasetLoader(path=source, format="json", schema="id long, text string")
    calls = []

    def dies(df):
        calls.append(1)
        if len(calls) == 3:
            df.limit(3).write.mode("overwrite").parquet(f"{state}/rows/batch=2")  # what a killed task leaves
            raise RuntimeError("killed")
        return df.where("true")

    with pytest.raises(Exception, match="killed"):
        load_once(spark, loader, state, 1, dies)
    assert batches_done(spark, state) == 2
    read = []
    rows = load_once(spark, loader, state, 1, lambda df: read.append(1) or df)
    assert sorted(r["id"] for r in rows.collect()) == list(range(100)) and rows.columns == ["id", "text"]
    assert batches_done(spark, state) == 5 and len(read) == 3 + 1  # three batches and the schema
    spark.range(100, 120).withColumn("text", F.lit("new")).coalesce(1).write.mode("append").json(source)
    assert sorted(r["id"] for r in load_once(spark, loader, state, 10).collect()) == list(range(120))
    assert files_of(spark, state).count() == 6 and files_of(spark, state).agg(F.max("batch")).first()[0] == 5
    assert load_once(spark, loader, state).count() == 120


def test_formats_splits_and_no_files(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id int, text string").coalesce(1).write.option("header", "true").csv(str(tmp_path / "c"))
    assert load_once(spark, DatasetLoader(path=str(tmp_path / "c"), format="csv"), str(tmp_path / "s1")).collect() == [("1", "a")]
    one = next((tmp_path / "c").glob("*.csv"))
    assert load_once(spark, DatasetLoader(path=str(one)), str(tmp_path / "s2")).count() == 1
    (tmp_path / "none").mkdir()
    empty = load_once(spark, DatasetLoader(path=str(tmp_path / "none"), schema="id long"), str(tmp_path / "s3"))
    assert empty.columns == ["id"] and empty.count() == 0 and batches_done(spark, str(tmp_path / "s3")) == 0


def test_pipelines_load_by_a_checkpoint(spark, tmp_path):
    spark.createDataFrame([(i, f"text of row {i}") for i in range(20)], "id long, text string").repartition(4).write.parquet(str(tmp_path / "in"))
    body = {"data_loader": {"type": "DatasetLoader", "params": {"path": str(tmp_path / "in")}, "checkpoint_path": str(tmp_path / "state"), "checkpoint_files": 3}, "stages": [{"name": "s", "operators": [{"name": "TextLengthFilter", "params": {"min_length": 14}}]}], "executor": {"metrics": {"enabled": False}}}
    assert Pipeline(configuration(body)).run(spark, write=False).output.count() == 10 and batches_done(spark, str(tmp_path / "state")) == 2
    with pytest.raises(ValueError, match="DatasetLoader"):
        Pipeline(configuration(body | {"data_loader": {"type": "ImageFolderLoader", "params": {"path": "x"}, "checkpoint_path": "y"}})).run(spark, write=False)
