"""All tables of a run appear together, and a run repeated under its id changes nothing."""

import pytest

from corpusmill.operators.base import DETAILS
from corpusmill.plans.config import configuration
from corpusmill.plans.runner import Pipeline
from corpusmill.sources import commit, writers


def _body(tmp_path):
    return {
        "data_loader": {"type": "DatasetLoader", "params": {"path": str(tmp_path / "in")}},
        "stages": [{"name": "lengths", "operators": [{"name": "TextLengthFilter", "params": {"min_length": 5}}], "output_path": str(tmp_path / "stages")}, {"name": "copies", "operators": [{"name": "TextExactDeduplicator"}]}],
        "data_writer": {"type": "ParquetDataWriter", "params": {"output_path": str(tmp_path / "out"), "table_name": "t"}},
        "executor": {"rejected_samples": {"enabled": True}, "metrics": {"output_path": str(tmp_path / "metrics")}},
    }


def _counts(spark, tmp_path):
    def count(path):
        return spark.read.parquet(str(path)).count() if path.exists() and list(path.rglob("*.parquet")) else 0

    return count(tmp_path / "out" / "t"), count(tmp_path / "out_rejected" / "t_rejected"), count(tmp_path / "stages" / "lengths")


@pytest.fixture
def pipeline(spark, tmp_path):
    spark.createDataFrame([(i, "text" + "x" * (i % 4)) for i in range(20)], "id long, text string").write.parquet(str(tmp_path / "in"))
    return Pipeline(configuration(_body(tmp_path)))


WHOLE = (3, 17, 15)


def test_a_failure_between_tables_leaves_nothing(spark, tmp_path, pipeline, monkeypatch):
    real = writers.ParquetDataWriter.write

    def fails(self, df, path=None):
        if self.table_name.endswith("_rejected"):
            raise RuntimeError("between")
        real(self, df, path)

    monkeypatch.setattr(writers.ParquetDataWriter, "write", fails)
    with pytest.raises(RuntimeError, match="between"):
        pipeline.run(spark, run_id="r1")
    assert _counts(spark, tmp_path) == (0, 0, 0)
    monkeypatch.setattr(writers.ParquetDataWriter, "write", real)
    result = pipeline.run(spark, run_id="r1")
    assert _counts(spark, tmp_path) == WHOLE and result.run_id == "r1"
    assert [(c["input_records"], c["output_records"]) for c in result.counts] == [(20, 15), (15, 3)]
    pipeline.run(spark, run_id="r1")
    assert _counts(spark, tmp_path) == WHOLE
    assert spark.read.parquet(str(tmp_path / "metrics" / "runs")).where("run_id = 'r1'").count() == 1
    pipeline.run(spark)  # another run adds its rows
    assert _counts(spark, tmp_path) == tuple(2 * n for n in WHOLE)
    assert {r["operator"] for r in spark.read.parquet(str(tmp_path / "out_rejected" / "t_rejected")).select("operator").distinct().collect()} == {"TextLengthFilter", "TextExactDeduplicator"}
    assert DETAILS in spark.read.parquet(str(tmp_path / "out_rejected" / "t_rejected")).columns


def test_a_failure_while_files_are_moved_is_mended(spark, tmp_path, pipeline, monkeypatch):
    real, moved = commit.RunCommit._move, []

    def half(self, found):
        moved.append(found)
        real(self, found[:1])
        raise RuntimeError("while moving")

    monkeypatch.setattr(commit.RunCommit, "_move", half)
    with pytest.raises(RuntimeError, match="moving"):
        pipeline.run(spark, run_id="r2")
    assert _counts(spark, tmp_path) != WHOLE and len(moved[0]) == 3
    monkeypatch.setattr(commit.RunCommit, "_move", real)
    pipeline.run(spark, run_id="r2")
    assert _counts(spark, tmp_path) == WHOLE
