"""Watermarks and event-time windows.

The watermark goes on the raw time column, before the window is made. On the window column itself it is
accepted but never advances: state then grows without end and closed windows are never emitted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = "window_time"


def windowed(df: DataFrame, time: str, delay: str, width: str, slide: str | None = None,
             name: str = WINDOW) -> DataFrame:
    """Rows with their window; with a slide shorter than the width, one row per window they fall in.

    The window carries the watermark from here on. A stream may have one such column, so the time column
    stays as a plain copy.
    """
    marked = df.withWatermark(time, delay)
    return (marked.withColumn(name, F.window(time, width, slide))
            .withColumn(time, F.timestamp_micros(F.unix_micros(time))))


def flat(df: DataFrame, name: str = WINDOW) -> DataFrame:
    """The window's two ends as columns of their own, first."""
    rest = [c for c in df.columns if c != name]
    return df.select(F.col(f"{name}.start").alias("window_start"), F.col(f"{name}.end").alias("window_end"), *rest)


def window_counts(df: DataFrame, time: str, delay: str, width: str, slide: str | None = None,
                  keys: list[str | Column] = ()) -> DataFrame:
    """Rows per window (and key). Counts are combined in each task, so a busy window is one row per task."""
    return (df.withWatermark(time, delay)
            .groupBy(F.window(time, width, slide).alias(WINDOW), *keys)
            .agg(F.count("*").alias("n"))
            .transform(flat))
