"""Runs a configuration: one plan for all stages, rows annotated rather than split, and counts taken on the way."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusmill.metrics import latency
from corpusmill.metrics.collector import new_run_id
from corpusmill.metrics.model import OPERATORS as OPERATOR_SCHEMA
from corpusmill.metrics.model import RUNS as RUN_SCHEMA
from corpusmill.metrics.model import STAGES as STAGE_SCHEMA
from corpusmill.metrics.store import MetricsStore
from corpusmill.operators.base import DETAILS, Operator, passed, rejected, with_details
from corpusmill.plans.config import Section
from corpusmill.plans.registry import LOADERS, OPERATORS, WRITERS
from corpusmill.sources.commit import RunCommit
from corpusmill.sources.loaders import DatasetLoader, limited
from corpusmill.sources.resume import load_once
from corpusmill.sources.writers import ParquetDataWriter

#: Says after which stage a row was rejected; only on the way, never in an output.
_STAGE = "_rejected_at_stage"
#: Of a worker, in the order of the metric table.
_LATENCIES = ("total_time", "avg_latency", "min_latency", "max_latency", "p50_latency", "p95_latency", "p99_latency")


@dataclass
class PipelineResult:
    run_id: str
    output: DataFrame
    rejected: DataFrame | None
    counts: list[dict] = field(default_factory=list)

    @property
    def totals(self) -> tuple[int, int]:
        return (self.counts[0]["input_records"], self.counts[-1]["output_records"]) if self.counts else (0, 0)


class Pipeline:
    def __init__(self, config: Section):
        self.config = config
        self.stages: list[tuple[str, list[Operator]]] = [(s.name, [OPERATORS.create(op.name, op.params) for op in s.operators if op.enabled]) for s in config.stages]

    def annotated(self, df: DataFrame, watch: bool = False, mark: bool = False) -> tuple[DataFrame, list[tuple[str, str, Observation]]]:
        """The plan over df, each row with the first rejection; with watch, counts of the live rows after each operator, and
        with mark the number of the stage that rejected a row."""
        df, seen = with_details(df), []
        if mark:
            df = df.withColumn(_STAGE, F.lit(None).cast("int"))
        if watch:
            start = Observation("start")
            df = df.observe(start, F.count(F.lit(1)).alias("n"))
            seen.append(("", "", start))
        for number, (stage, operators) in enumerate(self.stages):
            for i, op in enumerate(operators):
                df = op.annotate(df)
                if watch:
                    here = Observation(f"{number}-{stage}-{i}")
                    df = df.observe(here, F.count_if(F.col(DETAILS).isNull()).alias("n"))
                    seen.append((stage, op.name, here))
            if mark:
                df = df.withColumn(_STAGE, F.coalesce(F.col(_STAGE), F.when(F.col(DETAILS).isNotNull(), F.lit(number))))
        return df, seen

    def _loaded(self, spark: SparkSession, loader) -> DataFrame:
        """The loader's rows; with a checkpoint path, dataset files are loaded there in batches, and a killed run goes on."""
        path = self.config.data_loader.checkpoint_path
        if not path:
            return loader.load(spark)
        if not isinstance(loader, DatasetLoader):
            raise ValueError("data_loader.checkpoint_path needs a DatasetLoader")
        return load_once(spark, loader, path, self.config.data_loader.checkpoint_files)

    def _stored(self, spark: SparkSession, df: DataFrame) -> DataFrame:
        """df written once, for all that read it, to the folder the cluster shares; without one it is kept in memory or on disk."""
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            return df.persist()
        path = f"{shared.rstrip('/')}/annotated-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def run(self, spark: SparkSession, write: bool = True, run_id: str | None = None) -> PipelineResult:
        """Load, annotate once, and write the rows that passed each stage with an output_path, the end result, and rejected rows.

        Rejected rows go to <output_path>_rejected/<table_name>_rejected, in a folder for each operator. The Parquet tables of
        a run appear together once all are written; a run repeated under its run_id finishes what it began and adds
        nothing twice. Tables of other writers are theirs to commit, and come first.
        """
        config, settings = self.config, self.config.executor
        run_id, began = run_id or new_run_id(), datetime.now(UTC)
        loader = LOADERS.create(config.data_loader.type, config.data_loader.params)
        source = limited(self._loaded(spark, loader), settings.max_samples)
        times = self.profile(source) if settings.metrics.enabled and settings.metrics.profile else []
        start = time.monotonic()
        df, seen = self.annotated(source, settings.metrics.enabled, any(s.output_path for s in config.stages))
        df = self._stored(spark, df)
        plain = df.drop(_STAGE)
        out, bad = passed(plain), rejected(plain) if settings.rejected_samples.enabled else None
        if write and (tables := self._tables(df, out, bad)):
            run = RunCommit(spark, self._folder(), run_id)
            if run.begin():
                writers = [(WRITERS.create(kind, params), rows) for kind, params, rows in tables]
                for writer, rows in sorted(writers, key=lambda w: isinstance(w[0], ParquetDataWriter)):
                    if isinstance(writer, ParquetDataWriter):
                        writer.write(rows, run.aside(writer.path))
                    else:
                        writer.write(rows)
                run.commit()
        if not write or not config.data_writer.type:
            df.count()
        took = time.monotonic() - start
        result = PipelineResult(run_id, out, bad)
        if settings.metrics.enabled:
            counts = [o.get["n"] for *_, o in seen]
            result.counts = [{"stage_name": s, "operator_name": n, "input_records": counts[i], "output_records": counts[i + 1]} for i, (s, n, _) in enumerate(seen[1:])]
            if settings.metrics.write_on_completion and write:
                self._metrics(spark, result, began, took, times)
        return result

    def _folder(self) -> str:
        params = self.config.data_writer.params
        return params.get("output_path") or params.get("table_path") or next((s.output_path for s in self.config.stages if s.output_path), "./output")

    def _tables(self, df: DataFrame, out: DataFrame, bad: DataFrame | None) -> list[tuple[str, dict, DataFrame]]:
        """Writer, its parameters and rows of the tables of a run."""
        config, settings = self.config, self.config.executor.rejected_samples
        found = []
        for i, stage in enumerate(config.stages):
            if stage.output_path:
                rows = df.where(F.coalesce(F.col(_STAGE), F.lit(len(config.stages))) > i).drop(_STAGE, DETAILS)
                found.append(("ParquetDataWriter", {"output_path": stage.output_path, "table_name": stage.name}, rows))
        if not config.data_writer.type:
            return found
        params = config.data_writer.params
        found.append((config.data_writer.type, params, out))
        if bad is not None:
            base = params.get("output_path") or params.get("table_path", "./output")
            kind = settings.writer_type or "ParquetDataWriter"
            more = {"partition_by": "operator", "partition_key_path": f"{DETAILS}.operator"} if WRITERS.get(kind) is WRITERS.get("ParquetDataWriter") else {}
            found.append((kind, {"output_path": settings.output_path or f"{base.rstrip('/')}_rejected", "table_name": f"{params.get('table_name', 'default')}_rejected", **more}, bad))
        return found

    def profile(self, df: DataFrame) -> list[dict]:
        """Measured seconds, counts and latencies of each operator, run one after the other on what the one before kept.

        It runs every operator by itself, so it costs more than the fused plan; metrics have its figures if the setting
        metrics.profile is on, and no times of single operators otherwise. workers: the records that each worker got
        and kept, and the latencies of those it kept.
        """
        out, spark = [], df.sparkSession
        with latency.small_batches(spark):
            df = df.persist()
            given = {r["worker"]: r["records"] for r in latency.measured(df).groupBy("worker").agg(F.sum("records").alias("records")).collect()}
            for stage, operators in self.stages:
                for op in operators:
                    start = time.monotonic()
                    after = op.transform(df).persist()
                    found = {r["worker"]: r.asDict() for r in latency.by_worker(latency.measured(after)).drop("sketch").collect()}
                    took = time.monotonic() - start
                    df.unpersist()
                    before, n = sum(given.values()), sum(r["records"] for r in found.values())
                    workers = [{"worker": w, "input_records": given.get(w, 0), "output_records": found.get(w, {}).get("records", 0), **{k: found.get(w, {}).get(k) for k in _LATENCIES}} for w in sorted(given.keys() | found.keys())]
                    out.append({"stage_name": stage, "operator_name": op.name, "input_records": before, "output_records": n, "total_time": took, "throughput": before / took if took else 0.0, "workers": workers})
                    df, given = after, {w: r["records"] for w, r in found.items()}
            df.unpersist()
        return out

    def _metrics(self, spark: SparkSession, result: PipelineResult, began: datetime, took: float, times: list[dict]) -> None:
        """Rows of the three tables. Times, throughputs and latencies of single operators are those of profile(), with a row
        for each worker, else null and of one worker, spark: a fused plan has none."""
        store = MetricsStore(spark, self.config.executor.metrics.output_path)
        share = lambda a, b: 100.0 * b / a if a else 0.0
        rows, stamp = [], began.replace(tzinfo=None)
        measured = [t["total_time"] for t in times] or [None] * len(result.counts)
        for c in () if times else result.counts:
            n = c["input_records"]
            rows.append((result.run_id, c["stage_name"], c["operator_name"], "spark", stamp, n, c["output_records"], share(n, c["output_records"]), *[None] * 8, 0, "{}"))
        for t in times:
            for w in t["workers"]:
                n, took_here = w["input_records"], w["total_time"]
                rows.append((result.run_id, t["stage_name"], t["operator_name"], w["worker"], stamp, n, w["output_records"], share(n, w["output_records"]), *(w[k] for k in _LATENCIES), n / took_here if took_here else None, 0, "{}"))
        stages = []
        for name in dict.fromkeys(c["stage_name"] for c in result.counts):
            own = [(c, t) for c, t in zip(result.counts, measured, strict=True) if c["stage_name"] == name]
            a, b = own[0][0]["input_records"], own[-1][0]["output_records"]
            seconds = sum(t for _, t in own) if times else took if len(self.stages) == 1 else None
            workers = len({w["worker"] for t in times if t["stage_name"] == name for w in t["workers"]}) or 1
            stages.append((result.run_id, name, stamp, workers, a, b, share(a, b), seconds, *[a / seconds if seconds else None] * 3, 0))
        a, b = result.totals
        run = (result.run_id, stamp, datetime.now(UTC).replace(tzinfo=None), took, len(stages), a, b, share(a, b), a / took if took else 0.0, 0, "{}")
        store.write("operators", spark.createDataFrame(rows, OPERATOR_SCHEMA), result.run_id)
        store.write("stages", spark.createDataFrame(stages, STAGE_SCHEMA), result.run_id)
        store.write("runs", spark.createDataFrame([run], RUN_SCHEMA), result.run_id)
        if self.config.executor.metrics.generate_report:
            from corpusmill.metrics.report import write_report

            write_report(store, result.run_id, result.rejected, self.config.executor.metrics.debug_samples_per_operator)
