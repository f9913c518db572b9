"""Streaming segment scores: purchase features kept up to date per user, and scored when they change.

History (the batch layer) and new sales (the speed layer) are both rows of partial features. One streaming
aggregate folds them; its state is the up-to-date feature row of each user, so a batch costs its own rows
and the users it touches, and never reads history again. A batch that is run again starts from the state
before it, so nothing is counted twice.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.ml.segments import score_segments
from millrace.operators.aggregates import FEATURES, merge_features, neutral_features
from millrace.operators.keyed import KeyedTable
from millrace.streaming.sinks import Each

TOUCHED = "touched"


def sale_partials(sales: DataFrame, labels: list[str]) -> DataFrame:
    """A sale as partial features of its user; labels are known to history only."""
    items, price = F.col("items_count"), F.col("price")
    return sales.select(
        "user_id", *[F.lit("").alias(c) for c in labels], F.lit(1).cast("long").alias("c"),
        items.alias("s1"), items.alias("ma1"), items.alias("mi1"),
        price.alias("s2"), price.alias("ma2"), price.alias("mi2"), F.lit(1).alias(TOUCHED))


def running_features(history: DataFrame, sales: DataFrame, labels: list[str]) -> DataFrame:
    """Features of every user over history and all sales so far. For streams: use update mode."""
    known = neutral_features(history).select("user_id", *labels, *FEATURES, F.lit(0).alias(TOUCHED))
    both = known.unionByName(sale_partials(sales, labels))
    return merge_features(both, "user_id", [*labels, TOUCHED])


def score_into(path: str, table: KeyedTable, model: PipelineModel, labels: list[str]) -> Each:
    """Score users with new sales and upsert them; epoch 0 of the table is for its first rows.

    The changed features are written first: that evaluates the stateful part once, and what follows is an
    ordinary batch job over files, with adaptive execution.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        changed = f"{path}/features/epoch={epoch}"
        batch.filter(F.col(TOUCHED) == 1).write.mode("overwrite").parquet(changed)
        features = table.spark.read.schema(batch.schema).parquet(changed)
        scored = score_segments(model, features)
        table.write(scored.select("user_id", *labels, *FEATURES, F.col("category").alias("segment")), epoch + 1)

    return write
