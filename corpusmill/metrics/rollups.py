"""Roll-ups of operator metrics, each one aggregate or window over the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def operator_rollup(rows: DataFrame) -> DataFrame:
    """By stage and operator over its workers."""
    out = rows.groupBy("stage_name", "operator_name").agg(
        F.count("*").alias("num_workers"), F.sum("input_records").alias("input_records"), F.sum("output_records").alias("output_records"), F.avg("pass_rate").alias("pass_rate"), F.max("total_time").alias("total_time"),
        F.avg("avg_latency").alias("avg_latency"), F.avg("throughput").alias("avg_throughput"), F.min("throughput").alias("min_throughput"), F.max("throughput").alias("max_throughput"), F.sum("error_count").alias("error_count"), F.min("timestamp").alias("first_seen"),
    )
    return out.withColumn("overall_throughput", F.coalesce(F.try_divide(F.col("input_records").cast("double"), F.col("total_time")), F.lit(0.0)))


def stage_rollup(rows: DataFrame) -> DataFrame:
    """By stage: input of its first operator, output of its last, in the order of their first timestamps."""
    parts = rows.groupBy("stage_name", "operator_name").agg(F.sum("input_records").alias("i"), F.sum("output_records").alias("o"), F.min("timestamp").alias("t"))
    order = F.struct("t", "operator_name")
    flow = parts.groupBy("stage_name").agg(F.min_by("i", order).alias("input_records"), F.max_by("o", order).alias("output_records"))
    speed = F.when(F.col("throughput") > 0, F.col("throughput"))
    rest = rows.groupBy("stage_name").agg(F.countDistinct("worker_id").alias("num_workers"), F.max("total_time").alias("total_time"), F.coalesce(F.avg(speed), F.lit(0.0)).alias("avg_throughput"), F.coalesce(F.min(speed), F.lit(0.0)).alias("min_throughput"), F.coalesce(F.max(speed), F.lit(0.0)).alias("max_throughput"), F.sum("error_count").alias("error_count"), F.min("timestamp").alias("timestamp"))
    share = F.coalesce(F.try_divide(F.col("output_records") * 100.0, F.col("input_records")), F.lit(0.0))
    return flow.join(rest, "stage_name").withColumn("pass_rate", share)


def run_rollup(stages: DataFrame) -> DataFrame:
    """One row: input of the first stage, output of the last, by timestamp."""
    order = F.struct("timestamp", "stage_name")
    out = stages.agg(F.count("*").alias("num_stages"), F.min_by("input_records", order).alias("total_input_records"), F.max_by("output_records", order).alias("total_output_records"), F.sum("total_time").alias("duration"), F.sum("error_count").alias("total_errors"))
    n, took = F.col("total_input_records"), F.col("duration")
    return out.withColumns({"overall_pass_rate": F.coalesce(F.try_divide(F.col("total_output_records") * 100.0, n), F.lit(0.0)), "avg_throughput": F.coalesce(F.try_divide(n.cast("double"), took), F.lit(0.0))})


def nearest_rank_percentiles(rows: DataFrame, by: str, value: str, ranks=(0.5, 0.95, 0.99)) -> DataFrame:
    """p50, p95, p99 as the value at place int(n * q) of each group.

    Equal values are counted before the shuffle, and running sums go over distinct values only.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count("*").alias("c"))
    w = Window.partitionBy(by)
    placed = counts.select(by, value, F.sum("c").over(w.orderBy(value)).alias("upto"), F.sum("c").over(w).alias("n"))
    pick = lambda q: F.min(F.when(F.col("upto") > F.floor(F.col("n") * q), F.col(value)))
    return placed.groupBy(by).agg(F.max("n").alias("n"), *(pick(q).alias(f"p{round(q * 100)}") for q in ranks))


def timeline(stages: DataFrame) -> DataFrame:
    """Start and end of each stage if they ran one after the other."""
    w = Window.orderBy("timestamp", "stage_name").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("total_time").over(w), F.lit(0.0))
    return stages.select("stage_name", start.alias("start_time"), (start + F.col("total_time")).alias("end_time"))


def waterfall(stages: DataFrame) -> DataFrame:
    """Seconds of each stage and a row for their total."""
    return stages.rollup("stage_name").agg(F.sum("total_time").alias("total_time")).select(F.coalesce("stage_name", F.lit("TOTAL")).alias("stage_name"), "total_time")


def bottleneck(stages: DataFrame, operators: DataFrame) -> DataFrame:
    """The slowest stage, and the operator with the lowest mean throughput."""
    a = stages.agg(F.max_by("stage_name", F.struct("total_time", "stage_name")).alias("slowest_stage"), F.max("total_time").alias("stage_time"))
    b = operators.groupBy("operator_name").agg(F.avg("throughput").alias("t")).agg(F.min_by("operator_name", F.struct("t", "operator_name")).alias("slowest_operator"), F.min("t").alias("operator_throughput"))
    return a.join(b)  # one row each


def funnel(operators: DataFrame) -> DataFrame:
    """Edges of a flow: what each operator passes on to the next of its stage, and what it filters."""
    flow = operators.groupBy("stage_name", "operator_name").agg(F.sum("input_records").alias("i"), F.sum("output_records").alias("o"), F.min("timestamp").alias("t"))
    w = Window.partitionBy("stage_name").orderBy("t", "operator_name")
    flow = flow.select("stage_name", "operator_name", "i", "o", F.coalesce(F.lead("operator_name").over(w), F.lit("output")).alias("next"))
    edges = F.explode(F.array(F.struct(F.col("next").alias("target"), F.col("o").alias("records")), F.struct(F.lit("filtered").alias("target"), (F.col("i") - F.col("o")).alias("records"))))
    return flow.select("stage_name", F.col("operator_name").alias("source"), edges.alias("e")).select("stage_name", "source", "e.target", "e.records").where(F.col("records") > 0)


def latency_heatmap(operators: DataFrame) -> DataFrame:
    """First row of each operator, one value a row."""
    names = ("min", "p50", "p95", "p99", "max")
    first = operators.groupBy("operator_name").agg(*(F.min_by(f"{n}_latency", F.struct("timestamp", "worker_id")).alias(n) for n in names))
    return first.select("operator_name", F.explode(F.array(*(F.struct(F.lit(n).alias("measure"), F.col(n).alias("latency")) for n in names))).alias("e")).select("operator_name", "e.measure", "e.latency")


SLOW_OPERATORS = "SELECT operator_name, stage_name, AVG(throughput) AS avg_throughput, AVG(p95_latency) AS avg_p95_latency FROM operators GROUP BY operator_name, stage_name ORDER BY avg_throughput, operator_name, stage_name LIMIT 10"
LOWEST_PASS_RATE = "SELECT stage_name, AVG(pass_rate) AS avg_pass_rate, SUM(input_records) AS total_input FROM stages GROUP BY stage_name ORDER BY avg_pass_rate"
HOURLY_TREND = "SELECT DATE_TRUNC('hour', timestamp) AS hour, operator_name, AVG(throughput) AS avg_throughput, SUM(input_records) AS total_input FROM operators GROUP BY 1, 2"
