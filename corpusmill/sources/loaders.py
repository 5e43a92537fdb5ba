"""Loaders: dataset folders in Parquet, ORC, CSV, JSON or text, image folders, and web archives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Reader for each file ending.
FORMATS = {".parquet": "parquet", ".orc": "orc", ".csv": "csv", ".jsonl": "json", ".json": "json", ".txt": "text", ".avro": "avro"}


def limited(df: DataFrame, max_samples: int | None) -> DataFrame:
    """Exactly so many rows; None and 0 mean all."""
    return df.limit(max_samples) if max_samples else df


class DataLoader:
    """load(spark) gives the rows as a DataFrame; Spark splits the files over tasks and repeats failed ones."""

    def load(self, spark: SparkSession) -> DataFrame:
        raise NotImplementedError


class DatasetLoader(DataLoader):
    """Files of one format under a path that Spark reads; with split only those whose name begins with it.

    format: by default the ending of the path, else parquet. schema spares the inference of CSV and JSON.
    """

    def __init__(self, dataset_name: str | None = None, split: str | None = None, path: str | None = None, format: str | None = None, schema=None, **options):
        self.path, self.split, self.schema = path or dataset_name, split, schema
        if not self.path:
            raise ValueError("DatasetLoader needs dataset_name or path")
        ending = next((e for e in FORMATS if self.path.lower().endswith(e)), None)
        self.format = format or FORMATS.get(ending or "", "parquet")
        options.pop("streaming", None)  # older configurations have it; a scan is always a stream of batches
        self.options = options

    def load(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self.format).options(**{k: str(v) for k, v in self.options.items()})
        if self.format == "csv" and "header" not in self.options:
            reader = reader.option("header", "true")
        if self.schema is not None:
            reader = reader.schema(self.schema)
        if self.split and not any(self.path.lower().endswith(e) for e in FORMATS):
            reader = reader.option("pathGlobFilter", f"{self.split}*")
        return reader.load(self.path)


class ImageFolderLoader(DataLoader):
    """id (path), image.bytes of image files below a folder."""

    def __init__(self, path: str, pattern: str = "*.{png,jpg,jpeg,bmp,gif,webp}"):
        self.path, self.pattern = path, pattern

    def load(self, spark: SparkSession) -> DataFrame:
        files = spark.read.format("binaryFile").option("pathGlobFilter", self.pattern).option("recursiveFileLookup", "true").load(self.path)
        return files.select(F.col("path").alias("id"), F.struct(F.col("content").alias("bytes")).alias("image"))


class CommonCrawlLoader(DataLoader):
    """Readable text of the HTML responses of web archive files below a path.

    Columns crawl_id, warc_path, url, warc_date, title, text, text_length (bytes). num_files keeps the first files by
    name. Pages of under 100 characters, records that can't be read and pages without readable text are left out. Nothing is fetched from a network.
    """

    def __init__(self, crawl_id: str = "", path: str | None = None, base_url: str | None = None, cache_dir: str | None = None, num_files: int | None = None):
        self.crawl_id, self.path, self.num_files = crawl_id, path or cache_dir or base_url, num_files
        if not self.path:
            raise ValueError("CommonCrawlLoader needs the path of downloaded archive files")

    def load(self, spark: SparkSession) -> DataFrame:
        from corpusmill.operators.html import with_readable
        from corpusmill.sources.warc import read_warc

        pages = read_warc(spark, self.path, self.num_files, record_types="response", mime="text/html").where("error IS NULL AND length(html) >= 100")
        found = with_readable(pages.select("warc_path", "url", "warc_date", "html"), F.col("html"))
        return found.where("text IS NOT NULL").select(F.lit(self.crawl_id).alias("crawl_id"), "warc_path", "url", "warc_date", "title", "text", "text_length")
