"""Helpers that several operators share."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.session import materialize, scratch
from millrace.sources.tables import table_path

__all__ = ["batches_of", "bytes_of", "crc_of_id", "load", "map_texts", "materialize", "numbered", "row_chunks", "scratch", "set_apart",
           "split_text", "strings", "text_column", "text_rows", "with_lanes"]

ROWS_PER_DEAL = 2_000
ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXTS_PER_BATCH = 500
TEXT = "text_to_read"
LANE = "lane_of_row"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(folder, name))


def text_column(name: str = "text") -> Column:
    """The column with null read as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def crc_of_id(name: str = "doc_id") -> Column:
    """crc32 of the id written as text, unsigned; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


def set_apart(docs: DataFrame, *reads: str) -> DataFrame:
    """The table with every column but those of ``reads`` named by its place, so that no name is one of a result's."""
    return docs.toDF(*[c if c in reads else f"carried_{i}" for i, c in enumerate(docs.columns)])


def map_texts(rows: DataFrame, run, schema) -> DataFrame:
    """mapInArrow over rows with whole texts, whose batches are kept small unless the caller set their size."""
    conf = rows.sparkSession.conf
    if conf.get(ROWS_PER_BATCH) == "10000":
        conf.set(ROWS_PER_BATCH, str(TEXTS_PER_BATCH))
    return rows.mapInArrow(run, schema)


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Jobs that run inside send Python at most so many rows at a time."""
    before = spark.conf.get(ROWS_PER_BATCH)
    spark.conf.set(ROWS_PER_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ROWS_PER_BATCH, before)


def text_rows(docs: DataFrame, keep: list[str], *more: Column) -> tuple[DataFrame, str]:
    """The columns of ``keep`` and ``more`` with the text, which is carried once, and the schema of the former."""
    columns = [docs[f"`{c}`"] for c in keep] + list(more)
    rows = docs.select(*columns, *([] if "text" in keep else [F.col("text").alias(TEXT)]))
    return rows, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != TEXT)


def split_text(batch: pa.RecordBatch) -> tuple[pa.Array, list[pa.Array], list[str]]:
    """The text of a batch of ``text_rows``, its other columns, and their names."""
    names = batch.schema.names
    text = batch.column(names.index(TEXT if TEXT in names else "text"))
    kept = [n for n in names if n != TEXT]
    return text, list(batch.columns[:len(kept)]), kept


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column end to end, and where each row starts (one more entry than rows).

    Null is empty.
    """
    column = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[starts[0]:starts[-1]], starts - starts[0]


def strings(column: pa.Array) -> list[str]:
    """Python strings, null as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def row_chunks(starts: np.ndarray, most: int):
    """(first, last) row ranges of at most ``most`` bytes each; a longer row stands alone."""
    first, n = 0, len(starts) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + most, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def with_lanes(rows: DataFrame) -> DataFrame:
    """Rows with a number that no other row has. It is settled when they are stored."""
    return rows.withColumn(LANE, F.monotonically_increasing_id())


def numbered(rows: DataFrame, sizes: list[int], group: str, by: list[str], name: str) -> DataFrame:
    """Number the rows of each group 0, 1, ... without gathering a group in one task.

    ``sizes`` holds the rows of groups 0, 1, ... ``rows`` is a stored table from :func:`with_lanes`. Rows are dealt by a hash
    of ``by`` and the lane, about ROWS_PER_DEAL to a deal, numbered inside (group, deal), and shifted by the rows of the
    deals before. Rows that are equal otherwise have different lanes, and spread like all others.
    """
    by = [*by, LANE]
    deals = F.array(*[F.lit(max(1, -(-int(n) // ROWS_PER_DEAL))).cast("long") for n in sizes])
    rows = rows.withColumn("deal", F.pmod(F.xxhash64(*by), F.element_at(deals, F.col(group).cast("int") + 1)))
    counts = rows.groupBy(group, "deal").agg(F.count("*").alias("n"))
    before = Window.partitionBy(group).orderBy("deal").rowsBetween(Window.unboundedPreceding, 0)
    shifts = counts.select(group, "deal", (F.sum("n").over(before) - F.col("n")).alias("shift"))
    inside = F.row_number().over(Window.partitionBy(group, "deal").orderBy(*by)) - 1
    return rows.withColumn("inside", inside).join(shifts, [group, "deal"]).withColumn(
        name, (F.col("inside") + F.col("shift")).cast("long")).drop("deal", "inside", "shift", LANE)
