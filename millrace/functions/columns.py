"""Column expressions. All of them stay inside generated JVM code; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Labels, the date pattern, and the stand-in for "no minimum yet".
MILESTONE, NO_MILESTONE = "jubilee", "not yet"
DAY_MONTH_YEAR = "d/M/yyyy"
NO_MINIMUM = 9999999


def col(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def is_multiple(number: str | Column, of: int) -> Column:
    return col(number) % F.lit(of) == 0


def milestone(number: str | Column, every: int = 10) -> Column:
    return F.when(is_multiple(number, every), F.lit(MILESTONE)).otherwise(F.lit(NO_MILESTONE))


def same_length(left: str | Column, right: str | Column) -> Column:
    return F.length(col(left)) == F.length(col(right))


def day_month_year(text: str | Column) -> Column:
    """Date from text with one- or two-digit day and month; null for text that is no date."""
    return F.try_to_date(col(text), DAY_MONTH_YEAR)


def days_between(start: str | Column, end: str | Column) -> Column:
    """Days from one text date to another; null while either is missing."""
    return F.datediff(day_month_year(end), day_month_year(start))


def minimum_or_sentinel(minimum: str | Column) -> Column:
    """A missing minimum becomes a number that any real one beats in a later merge."""
    return F.coalesce(col(minimum), F.lit(NO_MINIMUM))


def unit_price_at_least(price: str | Column, value: str | Column, quantity: str | Column) -> Column:
    """Bought for something, and for at least ``price`` a piece. Zero quantities never reach the division."""
    value, quantity = col(value), col(quantity)
    return (value > 0) & (quantity > 0) & (F.try_divide(value, quantity) >= col(price))


def random_percent(seed: int | None = None) -> Column:
    return F.round(F.rand(seed) * 100)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def numeric_columns(df: DataFrame, but: Iterable[str] = ()) -> list[str]:
    skip = set(but)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]
