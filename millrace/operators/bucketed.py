"""Tables in folders by a hash bucket of their key, so that a batch of keys reads only its buckets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = "bucket"
ROWS_PER_BUCKET = 1_000_000
FEWEST, MOST = 8, 10_000


def buckets_for(rows: int) -> int:
    """Buckets for a table of about so many rows. The upper end bounds what a lookup may collect."""
    return min(max(FEWEST, -(-rows // ROWS_PER_BUCKET)), MOST)


def bucket_of(key: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key) if isinstance(key, str) else key), F.lit(buckets)).cast("int")


def put_buckets(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write a folder per bucket. Rebalancing gathers a bucket into few files and splits one that is large."""
    (df.withColumn(BUCKET, bucket_of(key, buckets)).hint("rebalance", BUCKET)
     .write.mode("overwrite").partitionBy(BUCKET).parquet(path))


def near_keys(stored: DataFrame, keys: DataFrame, key: str, buckets: int) -> DataFrame:
    """The buckets that hold any of ``keys``. What is collected is at most ``buckets`` numbers, never keys."""
    touched = [row[0] for row in keys.select(bucket_of(key, buckets)).distinct().collect()]
    return stored.filter(F.col(BUCKET).isin(touched))


@dataclass(frozen=True)
class Buckets:
    """A stored table, its key, and how it was cut."""

    rows: DataFrame
    key: str
    buckets: int

    def near(self, keys: DataFrame) -> DataFrame:
        """Rows in the buckets of ``keys``, for a join that follows."""
        return near_keys(self.rows, keys, self.key, self.buckets).drop(BUCKET)


def write_buckets(df: DataFrame, path: str, key: str, buckets: int) -> Buckets:
    put_buckets(df, path, key, buckets)
    schema = df.withColumn(BUCKET, F.lit(0)).schema
    return Buckets(df.sparkSession.read.schema(schema).parquet(path), key, buckets)
