"""Configuration, runner, metrics, images, archives, k-means, streams and the command line."""

import gzip
import json
from datetime import datetime

import numpy as np
import pytest
import yaml
from pyspark.sql import functions as F

from corpusmill.cli import main
from corpusmill.image import codec, quality
from corpusmill.metrics import rollups
from corpusmill.metrics.collector import MetricsCollector, nearest_rank, stage_of
from corpusmill.metrics.model import OPERATORS
from corpusmill.metrics.report import duplicate_groups, samples
from corpusmill.metrics.store import MetricsStore
from corpusmill.ml.kmeans import KMeansModel, KMeansTrainer, assign
from corpusmill.ml.linear import collapse, fold_batch_norm
from corpusmill.plans.config import configuration, replicas
from corpusmill.plans.registry import LOADERS
from corpusmill.plans.registry import OPERATORS as OPS
from corpusmill.plans.runner import Pipeline
from corpusmill.sources.warc import read_warc

DOCS = "/root/testdata/sf0.001/documents.parquet"


def _config(out):
    return {
        "data_loader": {"type": "HuggingFaceLoader", "params": {"dataset_name": DOCS}},
        "stages": [{"name": "clean", "operators": [{"name": "text_length_filter", "params": {"min_length": 100}}, {"name": "url_filter", "params": {"url_field": "source"}, "enabled": False}, {"name": "text_exact_deduplicator", "params": {"representative_id_field": "doc_id"}}], "worker": {"num_replicas": 2}}],
        "data_writer": {"type": "ParquetDataWriter", "params": {"output_path": f"{out}/docs"}},
        "executor": {"rejected_samples": {"enabled": True}, "metrics": {"output_path": f"{out}/metrics", "generate_report": True}},
    }


def test_pipeline_end_to_end(spark, tmp_path):
    result = Pipeline(configuration(_config(tmp_path))).run(spark)
    kept = spark.read.parquet(f"{tmp_path}/docs/default")
    gone = spark.read.parquet(f"{tmp_path}/docs_rejected/default_rejected")
    assert kept.count() + gone.count() == spark.read.parquet(DOCS).count()
    assert {r["operator"] for r in gone.select("operator").distinct().collect()} == {"TextLengthFilter", "TextExactDeduplicator"}
    assert result.totals == (200, kept.count())
    store = MetricsStore(spark, f"{tmp_path}/metrics")
    assert store.list_runs() == [result.run_id] and store.latest() == result.run_id
    rows = store.read("operators", result.run_id).collect()
    assert len(rows) == 2 and all(r["total_time"] is None and r["p95_latency"] is None for r in rows)  # nothing measured them
    page = (tmp_path / "metrics" / f"report_{result.run_id}.html").read_text()
    assert "TextExactDeduplicator" in page and "Rejected samples" in page and "Duplicate groups" in page and "<svg" in page and "class='cards'" in page
    profile = Pipeline(configuration(_config(tmp_path))).profile(spark.read.parquet(DOCS))
    assert profile[-1]["output_records"] == kept.count()


def test_previews_and_duplicate_groups(spark):
    rows = [(i, "x" * (499 + i), bytearray(b"abc"), "hidden", ("duplicate", "Op", f"k{i % 2}", None if i % 2 else "7")) for i in range(5)] + [(9, None, None, "h", ("filtered", "Other", None, None))]
    df = spark.createDataFrame(rows, "id long, text string, body binary, _own string, _rejection_details struct<reason:string,operator:string,dedup_key:string,representative_id:string>")
    shown = {json.loads(r["record"])["id"]: json.loads(r["record"]) for r in samples(df).collect()}
    assert shown[1] == {"id": 1, "text": "x" * 500, "body": "<binary: 3 bytes>"} and shown[2]["text"] == "x" * 500 + "..." and shown[9] == {"id": 9}
    got = {r["dedup_key"]: r for r in duplicate_groups(df, groups=2, members=2).collect()}
    assert {k: (r["duplicates"], r["representative_id"], len(r["samples"]), r["total_duplicates"], r["total_groups"]) for k, r in got.items()} == {"k0": (3, "7", 2, 5, 2), "k1": (2, "(not tracked)", 2, 5, 2)}
    assert list({r["dedup_key"] for r in duplicate_groups(df, groups=1).collect()}) == ["k0"]


def test_command_line(spark, tmp_path, capsys):
    path = tmp_path / "p.yaml"
    path.write_text(yaml.safe_dump(_config(tmp_path)))
    assert main(["run", "-c", str(path), "--max-samples", "50"]) == 0
    assert "50 in" in capsys.readouterr().out
    assert main([]) == 0
    assert main(["run", "-c", str(tmp_path / "none.yaml")]) == 1
    assert main(["report", "--metrics", f"{tmp_path}/metrics", "--output", f"{tmp_path}/r.html"]) == 0


def test_older_configuration_form():
    body = {"data_loader": {"type": "x"}, "data_writer": {"type": "y"}, "operators": [{"name": "a"}, {"name": "b", "params": {"k": 1}}], "workers": [{"name": "w", "operator_names": ["b", "c"], "num_replicas": 3}]}
    stage = configuration(body).stages[0]
    assert [o.name for o in stage.operators] == ["b"] and stage.worker.max_replicas == 3


def test_replicas():
    assert replicas({}) == (1, 1) and replicas({"num_replicas": 3}) == (3, 3) and replicas({"min_replicas": 2}) == (2, 2)
    assert replicas({"num_replicas": 4, "min_replicas": 2}) == (2, 4) and replicas({"num_replicas": 4, "max_replicas": 6}) == (4, 6)
    for bad in ({"min_replicas": 0}, {"min_replicas": 3, "max_replicas": 2}):
        with pytest.raises(ValueError):
            replicas(bad)


def test_configurations_are_checked():
    body = {"data_loader": {"type": "x", "num_workers": 4}, "stages": [{"name": "s", "operators": [{"name": "o"}]}], "executor": {"use_ray": False, "metrics": {"huggingface_repo": "r"}}}
    config = configuration(body)
    assert config.data_loader.unused == {"num_workers": 4} and config.executor.unused == {"use_ray": False} and config.executor.batch_size == 100
    assert config.stages[0].operators[0].params == {} and config.data_writer.type is None
    for bad in ({**body, "other": 1}, {**body, "data_loader": {}}, {**body, "executor": {"max_sample": 1}}):
        with pytest.raises(ValueError):
            configuration(bad)


def test_stage_outputs_and_measured_times(spark, tmp_path):
    body = _config(tmp_path)
    ops = body["stages"][0]["operators"]
    body["stages"] = [{"name": "short", "operators": ops[:1], "output_path": f"{tmp_path}/stages"}, {"name": "same", "operators": ops[2:]}]
    body["executor"]["metrics"] = {"output_path": f"{tmp_path}/metrics", "profile": True}
    result = Pipeline(configuration(body)).run(spark)
    first = spark.read.parquet(f"{tmp_path}/stages/short")
    docs = spark.read.parquet(DOCS)
    assert first.columns == docs.columns and first.count() == docs.where("length(text) >= 100").count() == result.counts[0]["output_records"]
    rows = MetricsStore(spark, f"{tmp_path}/metrics").read("operators", result.run_id).collect()
    assert {r["operator_name"] for r in rows} == {c["operator_name"] for c in result.counts}
    for c in result.counts:
        own = [r for r in rows if r["operator_name"] == c["operator_name"]]
        assert sum(r["output_records"] for r in own) == c["output_records"] and sum(r["input_records"] for r in own) == c["input_records"]
    assert all(0 < r["min_latency"] <= r["p50_latency"] <= r["p95_latency"] <= r["p99_latency"] <= r["max_latency"] for r in rows if r["output_records"])


def test_registry():
    for name in ("url_filter", "URLFilter", "image_siglip_embedding_refiner", "ImageAigcDetectorRefiner"):
        assert OPS.get(name)
    with pytest.raises(ValueError, match="UrlFilter"):
        OPS.get("none")
    assert "HuggingFaceLoader" in LOADERS.names()


def _operator(name, worker, n, out, took, minute):
    return {"run_id": "r", "stage_name": "s", "operator_name": name, "worker_id": worker, "timestamp": datetime(2026, 1, 1, 0, minute), "input_records": n, "output_records": out, "pass_rate": 100.0 * out / n, "total_time": took, "avg_latency": 0.0, "min_latency": 0.0, "max_latency": 0.0, "p50_latency": 0.0, "p95_latency": 0.0, "p99_latency": 0.0, "throughput": n / took, "error_count": 0, "custom_metrics": "{}"}


def test_stage_rollups_agree(spark):
    rows = [_operator("Op1", "worker_0", 100, 90, 1.0, 0), _operator("Op2", "worker_1", 100, 80, 1.5, 1)]
    one = stage_of("r", "s", rows)
    assert (one["input_records"], one["output_records"], one["pass_rate"], one["num_workers"], one["total_time"]) == (100, 80, 80.0, 2, 1.5)
    names = [c.strip().split()[0] for c in OPERATORS.split(",")]
    df = spark.createDataFrame([tuple(r[c] for c in names) for r in rows], OPERATORS)
    two = rollups.stage_rollup(df).first()
    for c in ("input_records", "output_records", "pass_rate", "num_workers", "avg_throughput", "min_throughput", "max_throughput"):
        assert two[c] == pytest.approx(one[c])
    assert stage_of("r", "s", [])["pass_rate"] == 0.0


def test_collector(spark, tmp_path):
    c = MetricsCollector()
    with c.track_run({"a": 1}), c.track_stage("s"):
        with c.track_operator("Op") as t:
            t.batch(100, 90, 1.0)
    assert c.stages[0]["output_records"] == 90 and c.runs[0]["overall_pass_rate"] == 90.0
    store = MetricsStore(spark, str(tmp_path))
    for table, found in (("operators", c.operators), ("stages", c.stages), ("runs", c.runs)):
        store.write_rows(table, found, c.run_id)
    assert store.read("operators").first()["input_records"] == 100
    store.write_rows("stages", [], "other")
    assert store.list_runs() == [c.run_id]
    assert [nearest_rank(list(range(1, 101)), q) for q in (0.5, 0.95, 0.99)] == [51, 96, 100]


def test_png_round_trip_with_all_filters():
    rng = np.random.default_rng(1)
    pixels = rng.integers(0, 256, (13, 9, 3), dtype=np.uint8)
    data = codec.encode_png(pixels)
    assert codec.header(data) == (9, 13, "PNG")
    assert (codec.decode(data)[0] == pixels).all()
    assert codec.decode(b"xx") is None and codec.header(b"xx") is None and codec.decode(None) is None
    for kind in range(5):  # undo each filter by its definition
        line, above = rng.integers(0, 256, 12, dtype=np.uint8), rng.integers(0, 256, 12, dtype=np.uint8)
        got, want = codec._unfilter(kind, line, above, 3), []
        for i, x in enumerate(line.tolist()):
            a, b, d = want[i - 3] if i >= 3 else 0, int(above[i]), int(above[i - 3]) if i >= 3 else 0
            p = a + b - d
            nearest = a if abs(p - a) <= abs(p - b) and abs(p - a) <= abs(p - d) else b if abs(p - b) <= abs(p - d) else d
            want.append((x + (0, a, b, (a + b) // 2, nearest)[kind]) & 255)
        assert got.tolist() == want


def test_image_measures():
    flat = np.full((64, 96, 3), 200, np.uint8)
    data = codec.encode_png(flat)
    assert quality.entropy(flat) == 0.0
    assert quality.artifacts(flat, len(data)) == pytest.approx(0.4 * (1 - min(1, 2 * len(data) / (64 * 96 * 3))))
    every = np.repeat(np.arange(256, dtype=np.uint8).reshape(16, 16)[..., None], 3, axis=2)
    assert quality.entropy(every) == pytest.approx(8.0)
    noise = np.random.default_rng(0).integers(0, 256, (100, 100, 3), dtype=np.uint8)
    assert quality.phash(noise) == quality.phash(noise) and len(quality.phash(noise)) == 64
    assert quality.phash(noise) != quality.phash(noise[::-1])
    assert quality.gradient_hash(noise)


def test_warc(spark, tmp_path):
    def record(kind, url, body):
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\nWARC-Date: 2026-01-01\r\nContent-Type: application/http\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"

    page = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>" + b"hello world " * 20 + b"</p>"
    parts = [record("request", "http://a", b"GET /"), record("response", "http://a", page), record("response", "http://b", page.replace(b"text/html", b"image/png"))]
    (tmp_path / "x.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    (tmp_path / "y.warc").write_bytes(b"".join(parts))
    assert read_warc(spark, str(tmp_path)).count() == 6
    found = LOADERS.create("CommonCrawlLoader", {"crawl_id": "c", "path": str(tmp_path)}).load(spark).collect()
    assert {(r["url"], r["warc_path"]) for r in found} == {("http://a", "x.warc.gz"), ("http://a", "y.warc")}
    assert found[0]["text"].startswith("hello world") and found[0]["text_length"] == len(found[0]["text"])


def test_kmeans_step_and_ties(spark, tmp_path):
    df = spark.createDataFrame([("a", [0.0, 0.0]), ("b", [0.0, 2.0]), ("c", [10.0, 0.0])], "id string, feature array<float>")
    start = np.array([[0.0, 0], [10, 0], [99, 99]])
    assert [r["cluster"] for r in assign(df, start).orderBy("id").collect()] == [0, 0, 1]
    after = KMeansTrainer(3).step(df, start)
    assert after.tolist() == [[0, 1], [10, 0], [99, 99]]
    assert KMeansModel(start).inertia(df) == pytest.approx(4.0)
    model = KMeansTrainer(3, init=start).train(df)
    assert model.converged and model.centroids.tolist() == after.tolist()
    model.save(str(tmp_path / "m.json"))
    assert (KMeansModel.load(str(tmp_path / "m.json")).centroids == model.centroids).all()
    with pytest.raises(ValueError):
        KMeansTrainer(2).train(spark.range(3))


def test_layers():
    rng = np.random.default_rng(0)
    layers = [(rng.normal(size=(4, 6)), rng.normal(size=4)), (rng.normal(size=(1, 4)), rng.normal(size=1))]
    w, b = collapse(layers)
    x = rng.normal(size=6)
    assert w @ x + b == pytest.approx(float((layers[1][0] @ (layers[0][0] @ x + layers[0][1]) + layers[1][1])[0]))
    weight, bias = fold_batch_norm(*layers[0], 0.5, np.full(4, 2.0), np.full(4, 3.0), 0.25)
    assert np.allclose(weight @ x + bias, (layers[0][0] @ x + layers[0][1] - 0.5) / np.sqrt(2 + 1e-5) * 3 + 0.25)


def test_stream_with_watermark(spark, tmp_path):
    from corpusmill.streaming.dedup import deduplicate, start

    rows = [(1, "a b", datetime(2026, 1, 1)), (2, "A  b", datetime(2026, 1, 1)), (3, "c", datetime(2026, 1, 1))]
    df = spark.createDataFrame(rows, "id long, text string, ts timestamp")
    df.write.parquet(str(tmp_path / "in"))
    stream = deduplicate(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), event_time="ts")
    start(stream, str(tmp_path / "state"), lambda batch, _: batch.write.mode("append").parquet(str(tmp_path / "out"))).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).select(F.count_distinct("dedup_key"), F.count("*")).first()[:] == (2, 2)
