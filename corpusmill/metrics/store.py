"""Metric tables as Parquet, a folder for each run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.metrics.model import TABLES


class MetricsStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, table: str, rows: DataFrame, run_id: str) -> None:
        """Rows of one run; without any, nothing is written."""
        if not rows.isEmpty():
            rows.drop("run_id").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{table}/run_id={run_id}")

    def write_rows(self, table: str, rows: list[dict], run_id: str) -> None:
        if rows:
            names = [c.strip().split()[0] for c in TABLES[table].split(",")]
            naive = lambda v: v.replace(tzinfo=None) if hasattr(v, "tzinfo") else v
            self.write(table, self.spark.createDataFrame([tuple(naive(r[c]) for c in names) for r in rows], TABLES[table]), run_id)

    def read(self, table: str, run_id: str | None = None) -> DataFrame:
        try:
            df = self.spark.read.schema(TABLES[table]).parquet(f"{self.path}/{table}")
        except Exception as problem:  # no run has written this table
            if "PATH_NOT_FOUND" not in str(problem):
                raise
            df = self.spark.createDataFrame([], TABLES[table])
        return df if run_id is None else df.where(F.col("run_id") == run_id)

    def list_runs(self) -> list[str]:
        return [r["run_id"] for r in self.read("runs").select("run_id").distinct().orderBy("run_id").collect()]

    def latest(self) -> str | None:
        return self.read("runs").agg(F.max_by("run_id", F.struct("start_time", "run_id"))).first()[0]

    def register_views(self) -> None:
        for table in TABLES:
            self.read(table).createOrReplaceTempView(table)
