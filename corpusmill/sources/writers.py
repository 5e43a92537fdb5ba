"""Writers: Parquet tables, with a folder for each partition key, and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpusmill.functions.records import partition_key


class DataWriter:
    def write(self, df: DataFrame) -> None:
        raise NotImplementedError

    def close(self) -> None:
        """Nothing is buffered."""


class ParquetDataWriter(DataWriter):
    """<output_path>/<table_name>, snappy; with partition_by a folder for each safe value at partition_key (a dotted path)."""

    def __init__(self, output_path: str, table_name: str = "default", partition_by: str | None = None, partition_key_path: str | None = None, mode: str = "append"):
        self.output_path, self.table_name, self.mode = output_path, table_name, mode
        self.partition_by, self.partition_key_path = partition_by, partition_key_path or partition_by

    @property
    def path(self) -> str:
        return f"{self.output_path.rstrip('/')}/{self.table_name}"

    def write(self, df: DataFrame, path: str | None = None) -> None:
        """Rows to the table, or to another path in the form of the table."""
        if self.partition_by:
            df = df.withColumn(self.partition_by, partition_key(df, self.partition_key_path))
        out = df.write.mode(self.mode).option("compression", "snappy").option("parquet.block.size", str(128 << 20))
        (out.partitionBy(self.partition_by) if self.partition_by else out).parquet(path or self.path)


class IcebergDataWriter(DataWriter):
    """Appends to catalog.namespace.table_name where such a catalog is configured, else Parquet under <table_path>/data."""

    def __init__(self, table_path: str | None = None, table_name: str = "default", namespace: str = "default", catalog: str = "iceberg", output_path: str | None = None, **_):
        self.table_path, self.table_name, self.namespace, self.catalog = table_path or output_path, table_name, namespace, catalog

    def write(self, df: DataFrame) -> None:
        spark = df.sparkSession
        if spark.conf.get(f"spark.sql.catalog.{self.catalog}", None):
            name = f"{self.catalog}.{self.namespace}.{self.table_name}"
            writer = df.writeTo(name)
            writer.append() if spark.catalog.tableExists(name) else writer.create()
            return
        if not self.table_path:
            raise ValueError("without a catalog, IcebergDataWriter needs table_path")
        df.write.mode("append").option("compression", "snappy").parquet(f"{self.table_path.rstrip('/')}/data")
