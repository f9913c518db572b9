"""Stream joins of folds: hot keys on either side, restarts, and what state holds."""

import datetime as dt
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.session import scratch
from millrace.sources import files
from millrace.streaming import joins, replay, sinks, windows

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "at timestamp, k long, v long"


def at(hours):
    return START + dt.timedelta(hours=hours)


def frame(spark, rows):
    return spark.createDataFrame([(at(h), k, v) for h, k, v in rows], SCHEMA).coalesce(2)


def sides(days=6):
    """(left, right) rows by day: key 1 holds most of the left side, key 2 most of the right one; key 3 is on the left
    alone, key 4 on the right alone, and both meet on odd days for key 5."""
    left, right = defaultdict(list), defaultdict(list)
    for d in range(days):
        left[d] += [(24 * d + i % 24, 1, i) for i in range(400)] + [(24 * d + 1, k, k) for k in (2, 3)]
        right[d] += [(24 * d + i % 24, 2, i) for i in range(400)] + [(24 * d + 2, k, 10 * k) for k in (1, 4)]
        if d % 2:
            left[d].append((24 * d + 5, 5, 50))
        right[d].append((24 * d + 6, 5, 500))
    return left, right


def expected(left, right, how, last):
    """(window start, key, left rows, right rows, right sum) of the windows that end by ``last`` hours."""
    folds = [defaultdict(list), defaultdict(list)]
    for fold, side in zip(folds, (left, right)):
        for rows in side.values():
            for h, k, v in rows:
                fold[h // 24, k].append(v)
    keys = set(folds[0]) & set(folds[1]) if how == "inner" else set(folds[1 if how == "right" else 0])
    return sorted((w, k, len(folds[0][w, k]) or None, len(folds[1][w, k]) or None, sum(folds[1][w, k]) if folds[1][w, k] else None)
                  for w, k in keys if 24 * (w + 1) <= last)


def found(run):
    rows = run.revisions().collect()
    assert len({(r["window_start"], r["k"]) for r in rows}) == len(rows)
    hours = {r["window_start"]: int((r["window_start"].replace(tzinfo=dt.timezone.utc) - START).total_seconds() // 3600) for r in rows}
    return sorted(((hours[r["window_start"]] // 24, r["k"], r["n"], r["m"], r["total"]) for r in rows), key=str)


def joined(left, right, how):
    return windows.flat(joins.folds_in_window(
        left, "at", [F.count("*").alias("n")], right, "at", [F.count("*").alias("m"), F.sum("v").alias("total")], ["k"],
        "1 day", "6 hours", how))


@pytest.mark.parametrize("how", ["inner", "left", "right"])
def test_folds_with_hot_keys_and_restarts(spark, how):
    left, right = sides()
    folders = [scratch(spark, "left"), scratch(spark, "right")]
    for folder, side in zip(folders, (left, right)):
        replay.land(frame(spark, side[0]), folder)
    streams = [files.stream_files(spark, folder, "parquet", frame(spark, left[0]).schema) for folder in folders]
    calls = []

    def flaky(path):
        write = sinks.by_epoch(path)

        def do(batch, epoch):
            write(batch, epoch)
            calls.append(epoch)
            if len(calls) == 3:
                raise RuntimeError("lost after the write")
        return do

    tracked = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    spark.conf.set(tracked, "true")
    try:
        run = sinks.Bounded(joined(*streams, how), "folds", do=flaky)
        failures = 0
        for d in range(len(left)):
            if d:
                replay.land(frame(spark, left[d]), folders[0])
                replay.land(frame(spark, right[d]), folders[1])
            try:
                query = run.drain()
            except Exception as e:
                assert "lost after the write" in str(e)
                failures += 1
                query = run.drain()  # from the checkpoint, the failed batch again
            state = sum(op.numRowsTotal for op in query.lastProgress.stateOperators)
            assert state <= 2 * 5 * 2 * 2  # two open days, five keys, two sides, folds and join
        assert failures == 1
    finally:
        spark.conf.set(tracked, "false")
    # The mark is six hours before the earlier of the two last times.
    last = min(max(h for h, _, _ in rows) for rows in (left[len(left) - 1], right[len(right) - 1])) - 6
    assert found(run) == sorted(expected(left, right, how, last), key=str)


def test_other_kinds_are_refused(spark):
    with pytest.raises(ValueError):
        joins.folds_in_window(spark.range(1), "t", [], spark.range(1), "t", [], ["k"], "1 day", "1 day", "full")


def test_hot_keys_are_combined_before_they_move(spark):
    """The plan has a partial aggregate under each exchange: a hot key leaves a task as one row."""
    left = frame(spark, sides()[0][0])
    plan = joined(left, left, "inner")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count(1)") == 2
