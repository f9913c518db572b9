"""A table arriving in event-time order, as a bounded and repeatable stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def time_slices(df: DataFrame, time: str, n: int, bounds: tuple | None = None) -> list[DataFrame]:
    """The table cut into n spans of equal length; together they hold each row once.

    Each slice is a plain filter on the time column, so a scan of a time-ordered table skips the rest.
    """
    low, high = bounds or time_range(df, time)
    if low is None:
        return [df, *[df.limit(0)] * (n - 1)]
    # Rounded up to whole microseconds, like the times they are compared with.
    edges = [F.timestamp_micros(F.lit(low - (low - high) * i // n)) for i in range(n + 1)]
    at = F.col(time)
    tests = [(at >= edges[i]) & (at < edges[i + 1]) for i in range(n)]
    if n > 1:
        tests[0], tests[-1] = at < edges[1], (at >= edges[-2]) | at.isNull()
    else:
        tests = [F.lit(True)]
    return [df.filter(test) for test in tests]


def number_slices(df: DataFrame, number: str, n: int) -> list[DataFrame]:
    """As :func:`time_slices`, by a whole number: n spans of equal length, in order; rows without one come last."""
    low, high = df.agg(F.min(number), F.max(number)).first()
    if low is None:
        return [df, *[df.limit(0)] * (n - 1)]
    edges, at = [low - (low - high) * i // n for i in range(n + 1)], F.col(number)
    tests = [(at >= edges[i]) & (at < edges[i + 1]) for i in range(n)]
    if n > 1:
        tests[0], tests[-1] = at < edges[1], (at >= edges[-2]) | at.isNull()
    else:
        tests = [F.lit(True)]
    return [df.filter(test) for test in tests]


def time_range(df: DataFrame, time: str) -> tuple[int | None, int | None]:
    """Earliest and latest time, in microseconds: plain numbers, free of the driver's own time zone."""
    return tuple(df.agg(F.min(F.unix_micros(time)), F.max(F.unix_micros(time))).first())


def land(df: DataFrame, folder: str) -> None:
    """Add a slice's files to the folder a stream reads."""
    df.write.mode("append").parquet(folder)


def arrive(feeds: Sequence[tuple[Sequence[DataFrame], str]], drain: Callable[[], None]) -> None:
    """Land slice after slice of every feed, and run the stream over all that is new after each.

    A slice is then exactly one micro-batch, however many files it has: files of one slice seen in two
    batches could count as late among themselves. Each run resumes from the query's checkpoint.
    """
    for step in zip(*[slices for slices, _ in feeds], strict=True):
        for (_, folder), piece in zip(feeds, step):
            land(piece, folder)
        drain()
