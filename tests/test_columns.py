import pytest
from pyspark.sql import functions as F

from helpers import rows
from millrace.functions import columns as C


def test_even_numbers_and_milestones(spark):
    numbers = spark.range(10).withColumnRenamed("id", "value")
    found = numbers.filter(C.is_multiple("value", 2)).withColumn("milestone_text", C.milestone("value"))
    assert rows(found) == [(0, "jubilee"), (2, "not yet"), (4, "not yet"), (6, "not yet"), (8, "not yet")]


def test_days_in_power(spark):
    terms = spark.createDataFrame([
        ("a", "20/01/1989", "20/01/1993"), ("b", "20/01/1993", "20/01/2001"), ("c", "4/3/1909", "4/03/1913"),
        ("d", "14/9/1901", "4/3/1909"), ("e", "20/01/2017", None), ("f", "no date", "20/01/2017"),
    ], "name string, took string, left_ string")
    found = dict(rows(terms.select("name", C.days_between("took", "left_"))))
    assert found == {"a": 1461, "b": 2922, "c": 1461, "d": 2728, "e": None, "f": None}


def test_same_length(spark):
    pairs = spark.createDataFrame([("perfumaria", "perfumery"), ("bebes", "bebee")], "a string, b string")
    assert rows(pairs.filter(C.same_length("a", "b"))) == [("bebes", "bebee")]


def test_float_division(spark):
    row = spark.sql("select cast(5.1 as float) / cast(1.4 as float) as r").first()
    assert row["r"] == pytest.approx(3.642857136775036)


def test_unit_price_never_divides_by_zero(spark):
    sales = spark.createDataFrame([(5.0, 5), (4.0, 5), (5.0, 0), (0.0, 1), (-3.0, -1)], "v double, q int")
    assert rows(sales.filter(C.unit_price_at_least(F.lit(1), "v", "q"))) == [(5.0, 5)]


def test_sentinel_lower_names_numeric_and_random(spark):
    df = spark.createDataFrame([(None, "x"), (3, "y")], "Minimum int, Name string")
    assert rows(df.select(C.minimum_or_sentinel("Minimum"))) == [(3,), (9999999,)]
    assert C.lower_names(df).columns == ["minimum", "name"]
    assert C.numeric_columns(df) == ["Minimum"]
    value = spark.range(50).select(C.random_percent(1).alias("r"))
    assert value.filter("r between 0 and 100 and r = round(r)").count() == 50
    assert rows(value) == rows(spark.range(50).select(C.random_percent(1)))
