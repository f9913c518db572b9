"""Streaming recommendations: each batch of purchases with recommended items, their precision and item facts."""

from __future__ import annotations

import time

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.ml.recommend import K, or_else, recommend, with_precision
from millrace.operators.bucketed import Buckets
from millrace.operators.joins import enrich
from millrace.streaming.sinks import Each


def recommend_into(path: str, model: ALSModel, pairs: Buckets, items: Buckets,
                   fallback: list[int] | None = None, k: int = K) -> Each:
    """Write enriched purchases to ``path/rows`` and one row of figures per batch to ``path/figures``.

    ``pairs`` is cut by user and ``items`` by item: a batch reads the buckets of its own keys, and no key
    passes through the driver.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        started = time.monotonic()
        batch.persist()
        users = batch.select("user_id").distinct()
        recs = recommend(model, users, k)
        if fallback:
            recs = or_else(users, recs, fallback)
        scored = with_precision(recs, pairs.near(users)).persist()
        try:
            rows = enrich(batch, scored, items.near(batch))
            rows.write.mode("overwrite").parquet(f"{path}/rows/epoch={epoch}")
            mean, count = scored.agg(F.avg("precision_at_k"), F.count("*")).first()
            batch.sparkSession.createDataFrame(
                [(mean, count, time.monotonic() - started)], "precision_at_k double, users long, seconds double",
            ).write.mode("overwrite").parquet(f"{path}/figures/epoch={epoch}")
        finally:
            scored.unpersist()
            batch.unpersist()

    return write
