"""Finding 1 of round 5: representatives of a stream are named as Spark writes their ids, and a batch counts once."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from corpusmill import queries
from corpusmill.streaming import dedup


@pytest.fixture
def store(spark):
    keys = ("spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.noDataMicroBatches.enabled")
    before = {k: spark.conf.get(k) for k in keys}
    dedup.use_key_state(spark)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(
    ("kind", "ids", "named"),
    [
        ("long", [None, 2**53 + 1, 10, 9], {None: "9", 2**53 + 1: "9", 10: "9", 9: None}),  # whole numbers beside a null
        ("long", [None, 2**53 + 1, 2**53 + 3], {None: str(2**53 + 1), 2**53 + 1: None, 2**53 + 3: str(2**53 + 1)}),
        ("double", [3e7, 1e7], {3e7: "1.0E7", 1e7: None}),
        ("long", [None, None], {None: ""}),
    ],
)
def test_ids_are_named_as_spark_writes_them(spark, store, tmp_path, kind, ids, named):
    schema = f"id {kind}, text string, n long"
    spark.createDataFrame([(i, "same", None if k else 2**53 + 1) for k, i in enumerate(ids)], schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    marked = dedup.annotate(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    assert marked.select("id", "text", "n").schema == spark.createDataFrame([], schema).schema
    dedup.start(marked, str(tmp_path / "state"), lambda df, _: df.write.parquet(str(tmp_path / "out"))).awaitTermination()
    got = [(r["id"], r["representative_id"], r["n"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(got) == len(ids) and sum(r[1] is None for r in got) == 1 and sorted(r[2] or 0 for r in got)[-1] == 2**53 + 1
    assert {i: r for i, r, _ in got if i is not None or r is not None} == named


@pytest.mark.parametrize("again", [False, True])
def test_query_with_null_ids_and_a_batch_that_runs_again(spark, store, tmp_path, monkeypatch, again):
    docs = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    ids = [None if i % 7 == 0 else i + 2**53 for i in docs["doc_id"].to_pylist()] if not again else docs["doc_id"].to_pylist()
    texts = [t for t in docs["text"].to_pylist()[:100] for _ in (0, 1)]
    pq.write_table(pa.table({"doc_id": pa.array(ids, pa.int64()), "text": texts}), tmp_path / "documents.parquet")
    monkeypatch.setattr(queries, "_scratch", lambda spark: str(tmp_path))
    start = dedup.start

    def stopped(stream, checkpoint, sink):
        """The first run ends after the last batch's rows are written and before it is noted as done."""
        start(stream, checkpoint, sink).awaitTermination()
        last = max((tmp_path / "state" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
        last.with_name(f".{last.name}.crc").unlink(missing_ok=True)
        last.unlink()
        return start(stream, checkpoint, sink)

    if again:
        monkeypatch.setattr(dedup, "start", stopped)
    out = queries.streaming_representatives(spark, str(tmp_path)).collect()
    assert sum(r["members"] for r in out) == 200 and all(r["firsts"] == 1 and r["named"] for r in out)
