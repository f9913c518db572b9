"""The registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from millrace.session import prepare, settings
from millrace.sources.tables import naive

Query = Callable[[SparkSession, str], DataFrame]

PARTITIONS = "spark.sql.shuffle.partitions"
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with equivalent SQL where there is any."""
    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            # State stores of the sample streams; a job of any size sets its own number.
            if PARTITIONS not in settings(spark):
                spark.conf.set(PARTITIONS, "16")
            return naive(build(prepare(spark), folder))

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql
        return run

    return register
