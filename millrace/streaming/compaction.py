"""Turning many small files into few large ones, into a new folder.

The folder that a file sink writes is never overwritten: its log would go with it, and the restarted query
would leave a folder that cannot be read. Readers move on to the new folder when it is complete.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGET_BYTES = 256 * 1024 * 1024


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Path and length of the files a read of ``path`` would use. Contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")


def files_needed(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> int:
    size = file_sizes(spark, path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return max(1, math.ceil(size / target_bytes))


def compact(spark: SparkSession, source: str, target: str, target_bytes: int = TARGET_BYTES,
            schema: T.StructType | None = None, partitioned_by: tuple[str, ...] = ()) -> int:
    """Rewrite a folder of parquet files with as many files as its size calls for; returns that number.

    Partitions of the scan are put together without a shuffle: each task reads its share of small files. A
    partitioned folder needs its partition columns, which it then has again, and a schema that types them: their
    types are not stored, only guessed from folder names.
    """
    if partitioned_by and schema is None:
        raise ValueError("a partitioned folder needs a schema")
    n = files_needed(spark, source, target_bytes)
    rows = (spark.read if schema is None else spark.read.schema(schema)).parquet(source)
    if partitioned_by:
        (rows.hint("rebalance", *partitioned_by).write.mode("overwrite").partitionBy(*partitioned_by).parquet(target))
    else:
        rows.coalesce(n).write.mode("overwrite").parquet(target)
    return n


def compact_closed(spark: SparkSession, source: str, target: str, column: str, before: str,
                   schema: T.StructType) -> None:
    """Compact the partitions ``column < before``, for example all days up to yesterday.

    Only those partitions of ``target`` are replaced, so that the same call can be repeated. Large
    partitions are split over several files.
    """
    closed = spark.read.schema(schema).parquet(source).filter(F.col(column) < before)
    (closed.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).parquet(target))


def read_compacted(spark: SparkSession, source: str, target: str, column: str, before: str,
                   schema: T.StructType) -> DataFrame:
    """Closed partitions from the compacted folder, the others from the original; a null partition stays open."""
    reader = spark.read.schema(schema)
    closed = reader.parquet(target).filter(F.col(column) < before)
    return closed.unionByName(reader.parquet(source).filter(
        (F.col(column) >= before) | F.col(column).isNull()))
