"""File, rate and literal sources."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader


def read_files(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Batch scan of csv, json, orc or parquet files; ``path`` may be a glob."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def stream_files(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str,
                 max_files: int | None = None, max_bytes: int | None = None, **options) -> DataFrame:
    """Stream of the files in a folder. ``max_files`` or ``max_bytes`` is an upper limit per micro-batch, never a wait; a
    file that is larger by itself makes a batch of its own."""
    return limited(spark.readStream.format(fmt).schema(schema).options(**options), max_files, max_bytes).load(path)


def limited(reader: DataStreamReader, max_files: int | None = None, max_bytes: int | None = None) -> DataStreamReader:
    """The reader with at most one of the two limits on a micro-batch."""
    if max_files and max_bytes:
        raise ValueError("a micro-batch is limited by files or by bytes, not by both")
    if max_files:
        return reader.option("maxFilesPerTrigger", max_files)
    return reader.option("maxBytesPerTrigger", max_bytes) if max_bytes else reader


def rate_stream(spark: SparkSession, rows_per_second: int = 1, **options) -> DataFrame:
    """Synthetic ``(timestamp, value)`` rows by the clock."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).options(**options).load()


def rate_per_batch(spark: SparkSession, rows_per_batch: int, **options) -> DataFrame:
    """Synthetic rows with a fixed number per micro-batch, so that a run can be repeated."""
    return (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch)
            .options(**options).load())


def store_scan(spark: SparkSession, table: str, keyspace: str,
               fmt: str = "org.apache.spark.sql.cassandra", **options) -> DataFrame:
    """Scan of an external keyed store through its connector, where the cluster has one."""
    return spark.read.format(fmt).options(table=table, keyspace=keyspace, **options).load()


def store_append(df: DataFrame, table: str, keyspace: str,
                 fmt: str = "org.apache.spark.sql.cassandra", **options) -> None:
    """Upsert into an external keyed store: the connector's append replaces rows with the same key."""
    df.write.format(fmt).options(table=table, keyspace=keyspace, **options).mode("append").save()


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A small fixed table, such as code descriptions."""
    return spark.createDataFrame(list(rows), schema)


def sql_over(df: DataFrame, view: str, statement: str) -> DataFrame:
    """Name a frame and run SQL on it."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(statement)


def save_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Save a catalog table cut and sorted by keys, and scan it. Tables with equally many buckets of the same keys join
    and group without a shuffle."""
    df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)
