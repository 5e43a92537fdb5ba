"""Loading that goes on where it was stopped: files in batches by an offset log, each batch written once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusmill.sources.loaders import FORMATS, DatasetLoader

#: The folder of a batch; a repeated batch takes the place of what an earlier try left.
_BATCH = "batch"


def load_once(spark: SparkSession, loader: DatasetLoader, checkpoint: str, files_at_once: int = 100, prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The rows of loader, as prepare makes them, from <checkpoint>/rows, after what is not there yet has been loaded.

    Files are taken files_at_once at a time. A log of them in <checkpoint>/offsets says, before a batch is read, which
    files it has, so a run that was killed repeats its last batch with the same files, into the same folder; batches that
    are done are not read again, and files that came since are loaded. So each row is there once. Files are known by
    their paths: a changed file is not read anew. The loader needs a schema, or files to infer one from.
    """
    schema = loader.schema if loader.schema is not None else loader.load(spark).schema
    reader = spark.readStream.format(loader.format).schema(schema).options(**{k: str(v) for k, v in loader.options.items()}).option("maxFilesPerTrigger", files_at_once)
    if loader.format == "csv" and "header" not in loader.options:
        reader = reader.option("header", "true")
    folder = loader.path.rstrip("/")
    if any(folder.lower().endswith(e) for e in FORMATS) and _is_file(spark, folder):  # a stream reads folders
        folder, _, name = folder.rpartition("/")
        reader = reader.option("pathGlobFilter", name)
    elif loader.split:
        reader = reader.option("pathGlobFilter", f"{loader.split}*")
    rows = f"{checkpoint.rstrip('/')}/rows"

    def sink(df: DataFrame, number: int) -> None:
        (prepare(df) if prepare else df).write.mode("overwrite").parquet(f"{rows}/{_BATCH}={number}")

    query = reader.load(folder).writeStream.foreachBatch(sink).option("checkpointLocation", f"{checkpoint.rstrip('/')}/log").trigger(availableNow=True).start()
    query.awaitTermination()
    kinds = (prepare(spark.createDataFrame([], schema)) if prepare else spark.createDataFrame([], schema)).schema
    try:
        return spark.read.schema(kinds).parquet(f"{rows}/{_BATCH}=*")
    except Exception as problem:  # the reader raises several kinds for a path that is not there
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return spark.createDataFrame([], kinds)


def batches_done(spark: SparkSession, checkpoint: str) -> int:
    """Batches that load_once() has finished at this checkpoint."""
    try:
        return spark.read.text(f"{checkpoint.rstrip('/')}/log/commits/*").where("value LIKE '{%'").count()
    except Exception as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return 0


def files_of(spark: SparkSession, checkpoint: str) -> DataFrame:
    """path and batch of the files that have been taken, from the log."""
    lines = spark.read.text(f"{checkpoint.rstrip('/')}/log/sources/0/*").where("value LIKE '{%'")
    return lines.selectExpr("from_json(value, 'path string, batchId long') AS f").selectExpr("f.path AS path", "f.batchId AS batch")


def _is_file(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).isFile()
