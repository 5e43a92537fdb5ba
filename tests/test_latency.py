"""Latency sketches against exact quantiles, and a profiled run of several workers."""

import numpy as np
from pyspark.sql import functions as F

from corpusmill.metrics import latency
from corpusmill.metrics.store import MetricsStore
from corpusmill.plans.config import configuration
from corpusmill.plans.runner import Pipeline


def test_quantiles_are_within_the_bound_of_a_sketch(spark):
    rng = np.random.default_rng(2)
    values = rng.lognormal(size=20_000)
    df = spark.createDataFrame([(f"w{i % 3}", 10, float(v) * 10) for i, v in enumerate(values)], _SCHEMA).repartition(7)
    workers = latency.by_worker(df)
    found = {r["worker"]: r for r in workers.drop("sketch").collect()}
    whole = latency.together(workers).first()
    for name, own in [(f"w{i}", values[i::3]) for i in range(3)] + [(None, values)]:
        r = found[name] if name else whole
        order = np.sort(own)
        assert r["records"] == 10 * len(own) and abs(r["min_latency"] - order[0]) < 1e-12 and abs(r["max_latency"] - order[-1]) < 1e-9
        assert abs(r["avg_latency"] - own.mean()) < 1e-9
        for column, q in latency.QUANTILES.items():
            assert abs(np.searchsorted(order, r[column]) / len(order) - q) < 0.03
    assert latency.by_worker(df.limit(0)).count() == 0


_SCHEMA = "worker string, records long, seconds double"


def test_a_profiled_run_has_latencies_of_several_workers(spark, tmp_path):
    spark.range(40_000).select("id", F.concat(F.lit("text of row "), F.col("id") % 30_000).alias("text")).repartition(8).write.parquet(str(tmp_path / "in"))
    body = {"data_loader": {"type": "DatasetLoader", "params": {"path": str(tmp_path / "in")}}, "stages": [{"name": "s", "operators": [{"name": "TextLengthFilter", "params": {"min_length": 15}}, {"name": "TextExactDeduplicator"}]}], "data_writer": {"type": "ParquetDataWriter", "params": {"output_path": str(tmp_path / "out")}}, "executor": {"metrics": {"output_path": str(tmp_path / "metrics"), "profile": True}}}
    result = Pipeline(configuration(body)).run(spark)
    store = MetricsStore(spark, str(tmp_path / "metrics"))
    rows = store.read("operators", result.run_id).collect()
    assert len({r["worker_id"] for r in rows}) > 1 and all(r["p99_latency"] > 0 for r in rows if r["output_records"])
    assert {c["operator_name"]: c["output_records"] for c in result.counts} == {n: sum(r["output_records"] for r in rows if r["operator_name"] == n) for n in ("TextLengthFilter", "TextExactDeduplicator")}
    assert store.read("stages", result.run_id).first()["num_workers"] == len({r["worker_id"] for r in rows})
