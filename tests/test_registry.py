"""Every registered query against its SQL, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from helpers import SF

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
# The text operators have tests of their own in tests/llm.
QUERIES, ORACLES = entry_point.catalog.queries(), entry_point.catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def comparable(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v

    return sorted(repr(tuple(cell(r[i]) for i in order)) for r in records)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = [tuple(r) for r in df.collect()]
    assert found
    expected = duck.execute(ORACLES[name])
    names = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(names)
    assert comparable(df.columns, found) == comparable(names, expected.fetchall())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
