"""Keyed tables: customers changed by their orders, in order of the order number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.bucketed import buckets_for
from millrace.operators.keyed import KeyedTable, mentions
from millrace.plans.registry import query
from millrace.session import scratch
from millrace.sources import files
from millrace.sources.tables import read_table

KEY = "c_custkey"
COLUMNS = {"c_mktsegment": "string", "c_acctbal": "double"}
EPOCH_EDGE = "1998-01-01"


def customer_table(spark: SparkSession, folder: str) -> KeyedTable:
    """All customers, as epoch 0."""
    customers = read_table(spark, folder, "customer").select(KEY, *COLUMNS)
    table = KeyedTable(spark, scratch(spark, "keyed"), KEY, "bigint", COLUMNS, buckets_for(customers.count()))
    table.write(customers, 0)
    return table


def order_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Each order changes its customer: priority goes to the segment, price to the balance."""
    return read_table(spark, folder, "orders").select(
        F.col("o_custkey").alias(KEY), F.col("o_orderkey").alias("step"), "o_orderstatus", "o_orderdate",
        F.col("o_orderpriority").alias("c_mktsegment"), F.col("o_totalprice").alias("c_acctbal"))


def changed_customers(spark: SparkSession, folder: str, change, deleted: Column | None = None) -> KeyedTable:
    """Epochs 1 and 2 hold the orders before and after a date; inside an epoch the order number decides."""
    table = customer_table(spark, folder)
    changes = change(order_changes(spark, folder))
    early = F.col("o_orderdate") < EPOCH_EDGE
    table.write(changes.filter(early), 1, "step", deleted)
    table.write(changes.filter(~early), 2, "step", deleted)
    return table


# SQL: every change with its place in the order of versions; the customers themselves come first.
CHANGES = f"""changes AS (
  SELECT c_custkey, 0 AS epoch, 0 AS step, c_mktsegment, c_acctbal, '' AS status FROM customer
  UNION ALL SELECT o_custkey, CASE WHEN o_orderdate < DATE '{EPOCH_EDGE}' THEN 1 ELSE 2 END, o_orderkey,
    o_orderpriority, o_totalprice, o_orderstatus FROM orders),
versions AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY epoch, step) AS v FROM changes)"""


@query(f"""WITH {CHANGES} SELECT c_custkey, c_mktsegment, c_acctbal FROM (
  SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY v DESC) AS back FROM versions) WHERE back = 1""")
def keyed_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return changed_customers(spark, folder, lambda orders: orders).read()


def by_status(orders: DataFrame) -> DataFrame:
    """F sets the segment only, O the balance only, P sets the balance to null."""
    status = F.col("o_orderstatus")
    return orders.withColumns({
        mentions("c_mktsegment"): status == "F",
        mentions("c_acctbal"): status != "F",
        "c_acctbal": F.when(status == "O", F.col("c_acctbal")),
    })


@query(f"""WITH {CHANGES} SELECT c_custkey, arg_max(c_mktsegment, v) FILTER (status IN ('', 'F')) AS c_mktsegment,
  coalesce(arg_max(CASE WHEN status = 'P' THEN -1e9 ELSE c_acctbal END, v) FILTER (status <> 'F'), 0) AS c_acctbal
FROM versions GROUP BY c_custkey""")
def keyed_partial_upsert(spark: SparkSession, folder: str) -> DataFrame:
    rows = changed_customers(spark, folder, by_status).read()
    return rows.withColumn("c_acctbal", F.coalesce("c_acctbal", F.lit(-1e9)))


@query(f"""WITH {CHANGES}, gone AS (SELECT c_custkey AS k, max(v) AS last FROM versions WHERE status = 'P' GROUP BY 1),
alive AS (SELECT versions.* FROM versions LEFT JOIN gone ON k = c_custkey WHERE last IS NULL OR v > last)
SELECT c_custkey, coalesce(arg_max(c_mktsegment, v) FILTER (status IN ('', 'F')), 'unset') AS c_mktsegment,
  coalesce(arg_max(c_acctbal, v) FILTER (status <> 'F'), -1e9) AS c_acctbal
FROM alive GROUP BY c_custkey""")
def keyed_delete(spark: SparkSession, folder: str) -> DataFrame:
    table = changed_customers(spark, folder, by_status, F.col("o_orderstatus") == "P")
    return table.read().fillna("unset").fillna(-1e9)


@query("""SELECT 'opened before' AS reader, c_custkey, c_mktsegment, c_acctbal FROM customer
UNION ALL SELECT 'opened after', o_custkey, arg_max(o_orderpriority, o_orderkey), arg_max(o_totalprice, o_orderkey)
FROM orders GROUP BY o_custkey""")
def keyed_replace(spark: SparkSession, folder: str) -> DataFrame:
    """One table, replaced: a frame opened before keeps its rows, one opened after has the new ones."""
    table = customer_table(spark, folder)
    before = table.read()
    table.replace(order_changes(spark, folder), 1, "step")
    return before.select(F.lit("opened before").alias("reader"), "*").unionByName(
        table.read().select(F.lit("opened after").alias("reader"), "*"))


@query("""SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_custkey IN (10, 77, 101)""")
def keyed_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return customer_table(spark, folder).lookup(10, 77, 101)


@query("""SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')""")
def keyed_batch_lookup(spark: SparkSession, folder: str) -> DataFrame:
    buyers = read_table(spark, folder, "events").filter("event_type = 'purchase'").select(
        F.col("user_id").alias(KEY))
    return customer_table(spark, folder).rows_of(buyers)


@query("""SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment""")
def keyed_scan_count(spark: SparkSession, folder: str) -> DataFrame:
    return customer_table(spark, folder).read().groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query(f"""WITH {CHANGES}, gone AS (SELECT c_custkey AS k, max(v) AS last FROM versions WHERE status = 'P' GROUP BY 1),
alive AS (SELECT versions.* FROM versions LEFT JOIN gone ON k = c_custkey WHERE last IS NULL OR v > last),
rows_now AS (SELECT c_custkey, coalesce(arg_max(c_mktsegment, v) FILTER (status IN ('', 'F')), 'unset') AS c_mktsegment,
  coalesce(arg_max(c_acctbal, v) FILTER (status <> 'F'), -1e9) AS c_acctbal FROM alive GROUP BY c_custkey)
SELECT reader, rows_now.* FROM rows_now, (VALUES ('opened before'), ('opened after')) AS readers(reader)""")
def keyed_compact(spark: SparkSession, folder: str) -> DataFrame:
    """One table with removed rows, its first two epochs folded to a base: the same rows before and after."""
    table = changed_customers(spark, folder, by_status, F.col("o_orderstatus") == "P")
    before = table.read()
    after = table.compact(1).read()
    return before.select(F.lit("opened before").alias("reader"), "*").unionByName(
        after.select(F.lit("opened after").alias("reader"), "*")).fillna("unset").fillna(-1e9)


@query("""SELECT c_custkey, c_mktsegment, c_acctbal FROM customer""")
def store_export(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "export")
    customer_table(spark, folder).read().write.parquet(path)
    return files.read_files(spark, path)
