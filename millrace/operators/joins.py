"""Joins of batch frames. Catalyst picks broadcast or shuffle by size; AQE splits hot partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def purchases(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Purchase rows (user, item, quantity, value) from order lines and their orders."""
    lines = lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("sales_value"),
    )
    heads = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("bought_at"),
    )
    return lines.join(heads, "order_id")


def keep_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``. The keys never pass through the driver."""
    return df.join(keys.select(*on).distinct(), on, "left_semi")


def enrich(batch: DataFrame, per_user: DataFrame, per_item: DataFrame,
           user: str = "user_id", item: str = "item_id") -> DataFrame:
    """A batch with what is known of each row's user and item; rows unknown to either stay."""
    return batch.join(per_user, [user], "left").join(per_item, [item], "left")


def sales(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One row per order that has lines: user, number of items, price, time."""
    counts = lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.sum(F.round("l_quantity").cast("long")).alias("items_count"))
    heads = orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("price"), F.col("o_orderdate").alias("order_date"))
    return heads.join(counts, "order_id")
