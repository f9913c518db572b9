"""Top-k reports, and places in an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import materialize


def top(df: DataFrame, by: str, tie: str, k: int) -> DataFrame:
    """The k highest rows, equal values in order of ``tie``. Each task keeps k rows; nothing is fully sorted."""
    return df.orderBy(F.desc(by), F.asc(tie)).limit(k)


def sold(sales: DataFrame, item: str = "item_id", quantity: str = "quantity", where: Column | None = None) -> DataFrame:
    """Total quantity of every item, over the rows that pass ``where``."""
    kept = sales if where is None else sales.filter(where)
    return kept.groupBy(item).agg(F.sum(quantity).alias(quantity))


def top_items(sales: DataFrame, k: int = 5000, item: str = "item_id", quantity: str = "quantity",
              where: Column | None = None) -> DataFrame:
    """The k items of which most was sold."""
    return top(sold(sales, item, quantity, where), quantity, item, k)


def best_per_category(ranked: DataFrame, category: str, by: str = "quantity", item: str = "item_id") -> DataFrame:
    """The best item of each category.

    A maximum over (value, -item) folds inside each task, where ranking rows in a window would sort a
    whole category in one place.
    """
    best = F.max(F.struct(F.col(by).alias(by), (-F.col(item)).alias("_item")))
    return (ranked.filter(F.col(category).isNotNull()).groupBy(category).agg(best.alias("_best"))
            .select(category, (-F.col("_best._item")).alias(item), F.col(f"_best.{by}").alias(by)))


def as_list(ranked: DataFrame, name: str, item: str = "item_id", *order: Column) -> DataFrame:
    """One row (name, list) from a short report, in its order."""
    keys = [o.alias(f"_{i}") for i, o in enumerate(order)]
    rows = F.array_sort(F.collect_list(F.struct(*keys, F.col(item).alias(item))))
    return ranked.agg(F.transform(rows, lambda r: r[item]).alias("list")).select(F.lit(name).alias("name"), "list")


def in_order(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows with their place 0, 1, ... in an order, without a window over the whole table.

    Rows are range partitioned, stored with their partition, numbered inside it, and shifted by the rows of the
    partitions before. Rows that are equal in ``order`` meet in one partition: end it with a key.
    """
    spread = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    parts = materialize(spread, "in-order")
    counts = parts.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part")) - F.col("_rows")
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    numbered = parts.withColumn("_inside", inside).join(counts.select("_part", before.alias("_before")), "_part")
    return numbered.withColumn(name, (F.col("_inside") + F.col("_before")).cast("long")).drop("_part", "_inside", "_before")


def in_groups(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """Rows with their place 0, 1, ... inside their group, null being a group too, in an order.

    As :func:`in_order`, for few groups of very many rows: rows are range partitioned by group and order, numbered inside
    each part of a group, and shifted by the rows of the group's parts before.
    """
    spread = df.repartitionByRange(F.col(group), *order).withColumn("_part", F.spark_partition_id())
    parts = materialize(spread, "in-groups")
    counts = parts.groupBy(group, "_part").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy(group).orderBy("_part")) - F.col("_rows")
    inside = F.row_number().over(Window.partitionBy("_part", group).orderBy(*order)) - 1
    starts = counts.select(F.col(group).alias("_group"), F.col("_part").alias("_of"), before.alias("_before"))
    numbered = parts.withColumn("_inside", inside).join(
        starts, (F.col("_part") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_group")))
    return numbered.withColumn(name, (F.col("_inside") + F.col("_before")).cast("long")).select(*df.columns, name)
