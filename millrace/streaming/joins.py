"""Joins of streams with tables and with other streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.skew import SALT, pinned, replicate, scatter
from millrace.streaming.windows import WINDOW, windowed


def with_table(stream: DataFrame, table: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Stateless join of each micro-batch with a table ("inner", or "left" to keep unmatched rows)."""
    return stream.join(table, on, how)


def within_window(left: DataFrame, left_time: str, right: DataFrame, right_time: str, on: list[str], width: str,
                  delay: str, how: str = "inner", heavy: DataFrame | None = None,
                  spread_by: list[str | Column] = (), heavy_at: str | None = None) -> DataFrame:
    """Join two streams on keys and event-time window.

    ``how`` is "inner" or "right"; a right row without a partner appears once the watermark has passed its
    window. Both sides carry a watermark, so both states are dropped as windows close. Stateful joins get
    no skew handling from Spark: for keys with very many right rows pass ``heavy`` (from
    :func:`millrace.operators.skew.heavy_keys` over the right side), right columns to spread them by, and ``heavy_at``,
    a folder beside the checkpoint. The first start keeps the table there and later ones use it: state holds rows
    under its salts.
    """
    if how not in ("inner", "right"):
        raise ValueError(f"a salted window join can be inner or right, not {how}")
    if heavy is not None and heavy_at is None:
        raise ValueError("heavy keys need heavy_at, a folder that lives as long as the checkpoint")
    left = windowed(left, left_time, delay, width)
    right = windowed(right, right_time, delay, width)
    keys = [*on, WINDOW]
    if heavy is None:
        return left.join(right, keys, how)
    heavy = pinned(heavy, heavy_at)
    left = replicate(left, heavy, on)
    right = scatter(right, heavy, on, list(spread_by))
    return left.join(right, [*keys, SALT], how).drop(SALT)


def folded(df: DataFrame, time: str, keys: list[str], width: str, delay: str, folds: list[Column]) -> DataFrame:
    """A stream's rows folded to one per key and event-time window, given on when the window closes."""
    return df.withWatermark(time, delay).groupBy(F.window(time, width).alias(WINDOW), *keys).agg(*folds)


def folds_in_window(left: DataFrame, left_time: str, left_folds: list[Column], right: DataFrame, right_time: str,
                    right_folds: list[Column], on: list[str], width: str, delay: str, how: str = "inner") -> DataFrame:
    """Fold both streams by key and window, and join the folds.

    Two chained stateful operators: an aggregate on each side, with partial results in each task, and the join of what
    they give. State holds a row per key for the few windows that are open, however many rows a key has, and a key that
    holds a third of either side is one row per task. ``how`` is "inner", "left" or "right"; a fold without a partner
    appears once the watermark has passed its window.
    """
    if how not in ("inner", "left", "right"):
        raise ValueError(f"folds can be joined inner, left or right, not {how}")
    return folded(left, left_time, on, width, delay, left_folds).join(
        folded(right, right_time, on, width, delay, right_folds), [*on, WINDOW], how)
