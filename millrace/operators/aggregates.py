"""Grouped aggregates. All of them combine inside each task before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import minimum_or_sentinel, numeric_columns

# The names of the purchase features (count; sum, maximum, minimum of two measures).
FEATURES = ["c", "s1", "ma1", "mi1", "s2", "ma2", "mi2"]
MINIMA = ["mi1", "mi2"]


def means(df: DataFrame, *keys: str) -> DataFrame:
    """Mean of every numeric column per group; other columns are left out."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"avg_{c}") for c in numeric_columns(df, but=keys)])


def purchase_features(sales: DataFrame, keys: list[str], items: str, price: str) -> DataFrame:
    """Count of sales, and sum, maximum and minimum of their item number and price."""
    return sales.groupBy(*keys).agg(
        F.count("*").alias("c"),
        F.sum(items).alias("s1"), F.max(items).alias("ma1"), F.min(items).alias("mi1"),
        F.sum(price).alias("s2"), F.max(price).alias("ma2"), F.min(price).alias("mi2"),
    )


def neutral_features(df: DataFrame) -> DataFrame:
    """Missing features become values that change nothing in a merge: 0, and a large number for minima."""
    return df.withColumns({c: minimum_or_sentinel(c) for c in MINIMA}).na.fill(0)


def merge_features(partials: DataFrame, key: str, labels: list[str]) -> DataFrame:
    """Fold partial features of the same key, from history, batches or both, to one row.

    Text labels are merged by maximum: a partial that does not know them carries an empty text.
    """
    how = {"c": F.sum, "s1": F.sum, "s2": F.sum, "ma1": F.max, "ma2": F.max, "mi1": F.min, "mi2": F.min}
    return partials.groupBy(key).agg(*[F.max(c).alias(c) for c in labels],
                                     *[how[c](c).alias(c) for c in FEATURES])


def item_lists(df: DataFrame, user: str, item: str, name: str = "own") -> DataFrame:
    """Each user's distinct items, sorted.

    Pairs are made distinct first: that shuffle spreads by user and item together, so what moves by user
    alone afterwards is one row per different item, however often it was bought.
    """
    pairs = df.select(user, item).distinct()
    return pairs.groupBy(user).agg(F.array_sort(F.collect_list(item)).alias(name))


def profile(df: DataFrame, distinct: list[str]) -> DataFrame:
    """One row: number of rows, and of different values of each named column.

    Spark makes (column, value) pairs distinct in an ordinary shuffle before it counts them.
    """
    return df.agg(F.count("*").alias("total_rows"),
                  *[F.count_distinct(c).alias(f"distinct_{c}") for c in distinct])


def mean_of(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    return df.agg(F.avg(column).alias(name or f"avg_{column}"))
