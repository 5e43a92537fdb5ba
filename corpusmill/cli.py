"""Command line: run a pipeline, report on a run, train k-means."""

from __future__ import annotations

import argparse
import sys

from corpusmill import __version__


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("corpusmill").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _run(args) -> None:
    from corpusmill.plans.config import from_yaml
    from corpusmill.plans.runner import Pipeline

    config = from_yaml(args.config)
    if args.max_samples is not None:
        config.executor.max_samples = args.max_samples
    if args.batch_size is not None:
        config.executor.batch_size = args.batch_size
    spark = _session()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(max(1, config.executor.batch_size)))
    result = Pipeline(config).run(spark)
    a, b = result.totals
    print(f"{result.run_id}: {a} in, {b} out, {100 * (a - b) / a if a else 0:.1f} % filtered")
    for c in result.counts:
        print(f"  {c['stage_name']}/{c['operator_name']}: {c['input_records']} -> {c['output_records']}")


def _report(args) -> None:
    from corpusmill.metrics.report import write_report
    from corpusmill.metrics.store import MetricsStore

    print(write_report(MetricsStore(_session(), args.metrics), args.run_id, output=args.output))


def _kmeans(args) -> None:
    from corpusmill.ml.kmeans import KMeansTrainer

    data = _session().read.parquet(args.input)
    model = KMeansTrainer(args.clusters, args.seed, max_iterations=args.iterations, tolerance=args.tolerance).train(data, args.id_field, args.feature_field)
    model.save(args.output)
    print(f"{model.iterations} iterations, converged: {model.converged}, saved to {args.output}")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="corpusmill")
    top.add_argument("-V", "--version", action="version", version=f"corpusmill {__version__}")
    commands = top.add_subparsers(dest="command")
    run = commands.add_parser("run", help="run a pipeline")
    run.add_argument("-c", "--config", required=True)
    run.add_argument("--max-samples", type=int)
    run.add_argument("--batch-size", type=int)
    run.set_defaults(do=_run)
    report = commands.add_parser("report", help="write a run's report")
    report.add_argument("--metrics", required=True)
    report.add_argument("--run-id")
    report.add_argument("--output")
    report.set_defaults(do=_report)
    means = commands.add_parser("kmeans", help="train k-means")
    means.add_argument("--input", required=True)
    means.add_argument("--output", required=True)
    means.add_argument("--clusters", type=int, default=100)
    means.add_argument("--seed", type=int, default=42)
    means.add_argument("--iterations", type=int, default=100)
    means.add_argument("--tolerance", type=float, default=1e-4)
    means.add_argument("--id-field", default="id")
    means.add_argument("--feature-field", default="feature")
    means.set_defaults(do=_kmeans)
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if not args.command:
        parser().print_help()
        return 0
    try:
        args.do(args)
    except Exception as problem:
        print(f"error: {problem}", file=sys.stderr)
        return 1
    return 0
