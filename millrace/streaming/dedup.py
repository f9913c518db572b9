"""Removing repeated rows from streams."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_seen(df: DataFrame, keys: list[str], keep: Iterable[str] = ()) -> DataFrame:
    """One row per key, emitted in the micro-batch where the key first occurs. For update mode.

    Include the event time or its window in ``keys``, under a watermark, to bound the state. Columns in
    ``keep`` come from one of the key's rows in that first batch.

    Rows of a key are combined inside each task before they move, so a key that holds a third of all rows
    costs one row per task. All rows of a micro-batch have the same processing time: a key whose first and
    last processing time agree has not been seen in an earlier batch.
    """
    carried = [F.first(F.struct(*keep)).alias("_kept")] if keep else []
    found = (df.withColumn("_seen", F.current_timestamp()).groupBy(*keys)
             .agg(F.min("_seen").alias("_first"), F.max("_seen").alias("_last"), *carried))
    return found.filter("_first = _last").select(*keys, *(["_kept.*"] if keep else []))


def drop_repeats(df: DataFrame, keys: list[str]) -> DataFrame:
    """The same in append mode, with all columns of the kept row.

    Every row is sent to its key's task: right for keys with few rows each, such as message ids.
    """
    return df.dropDuplicates(keys)


def drop_repeats_lately(df: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """The first row of each key among those that come within ``delay``; older keys are forgotten."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
