"""Intermediate tables go when a result is written."""

import os

import pytest

import corpus_pipeline
from corpusmill.llm import minhash, storage


def _tables(folder):
    return sorted(d.rsplit("-", 1)[0] for d in os.listdir(folder))


@pytest.fixture
def folder(tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "shared_dir", lambda spark: f"file://{tmp_path}/shared")
    return tmp_path / "shared"


def test_tables_of_an_operator_go(spark, folder, tmp_path):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "x y z")], "doc_id long, text string")
    with storage.swept(spark) as keep:
        out = storage.materialize(minhash.near_duplicates(docs), "result")
        keep.add(out.written_to)
        assert len(_tables(folder)) > 5
    assert _tables(folder) == ["result"] and out.where("kept").count() == 2
    with storage.swept(spark), pytest.raises(ValueError, match="stop"):
        storage.materialize(docs, "more")
        raise ValueError("stop")
    assert _tables(folder) == ["result"]
    storage.discard(out)


def test_the_pipeline_leaves_what_its_result_reads(spark, folder):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert _tables(folder) == ["decontamination"] and out.count() > 0
