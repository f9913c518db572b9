"""Spreading hot keys over many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import exists

SALT = "_salt"


def heavy_keys(df: DataFrame, keys: list[str], rows_per_salt: int = 1_000_000) -> DataFrame:
    """Keys with more rows than one task should hold (``rows_per_salt``), each with the number of salts it needs.

    Counting is a partial aggregate per task before its shuffle, so a hot key costs one row per task. The
    result has at most one row per ``rows_per_salt`` rows; Spark chooses by its size how to join it.
    """
    return (df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > rows_per_salt)
            .select(*keys, F.ceil(F.col("_rows") / rows_per_salt).cast("int").alias("_salts")))


def scatter(df: DataFrame, heavy: DataFrame, keys: list[str], spread_by: list[str | Column]) -> DataFrame:
    """Give each row of the large side a salt: by content within a heavy key's range, 0 for other keys."""
    salted = df.join(heavy, keys, "left")
    salt = F.pmod(F.xxhash64(*spread_by), F.coalesce(F.col("_salts"), F.lit(1)))
    return salted.withColumn(SALT, salt.cast("int")).drop("_salts")


def replicate(df: DataFrame, heavy: DataFrame, keys: list[str]) -> DataFrame:
    """Copy the other side's rows once per salt of their key; rows of ordinary keys stay single."""
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    return df.join(heavy, keys, "left").withColumn(SALT, copies).drop("_salts")


def pinned(heavy: DataFrame, path: str) -> DataFrame:
    """The table of heavy keys that belongs to a checkpoint: stored at ``path`` by the first start, and read from
    there by every later one, whatever it is given. State holds rows under the salts of the first table, so another
    one would lose pairs."""
    spark = heavy.sparkSession
    if not exists(spark, f"{path}/_SUCCESS"):
        heavy.write.mode("overwrite").parquet(path)
    return spark.read.schema(heavy.schema).parquet(path)
