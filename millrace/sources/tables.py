"""Parquet tables as batch frames and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.sources.files import limited


def table_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def zoned_schema(schema: T.StructType) -> T.StructType:
    """The same schema with zone-less timestamps read as UTC instants.

    Event time has to be ``timestamp``. Asking the parquet reader for that type, instead of casting
    afterwards, keeps filters on the column inside the scan.
    """
    return T.StructType([
        T.StructField(f.name, T.TimestampType() if f.dataType == T.TimestampNTZType() else f.dataType, f.nullable)
        for f in schema
    ])


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = table_path(folder, name)
    return spark.read.schema(zoned_schema(spark.read.parquet(path).schema)).parquet(path)


def stream_table(spark: SparkSession, folder: str, name: str, max_files: int | None = None,
                 max_bytes: int | None = None) -> DataFrame:
    """Stream a table's files from where they lie, without a copy.

    A table can be a folder of files or one file; the file source reads folders only, so one file is
    read through a name filter on its parent.
    """
    path = table_path(folder, name)
    table = spark.read.parquet(path)
    reader = limited(spark.readStream.schema(zoned_schema(table.schema)), max_files, max_bytes)
    first = spark.read.format("binaryFile").load(path).select("path").first()
    if first and first["path"].endswith(f"/{name}.parquet"):
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return reader.parquet(path)


def naive(df: DataFrame) -> DataFrame:
    """Timestamps back to the zone-less type the tables were written with."""
    return df.select([
        df[f.name].cast(T.TimestampNTZType()).alias(f.name) if f.dataType == T.TimestampType() else df[f.name]
        for f in df.schema
    ])
