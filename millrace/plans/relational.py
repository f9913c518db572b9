"""Batch queries: expressions, joins, aggregates, top-k, splits."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.ml.recommend import owned, precision
from millrace.operators import aggregates as A
from millrace.operators import joins as J
from millrace.operators import ranking as R
from millrace.operators import sampling as S
from millrace.operators.bucketed import buckets_for
from millrace.plans.registry import query
from millrace.session import materialize, scratch
from millrace.sources import files, messages
from millrace.sources.tables import read_table

TOP_ITEMS = 500
TOP_CATEGORIES = 5


def all_purchases(spark: SparkSession, folder: str) -> DataFrame:
    return J.purchases(read_table(spark, folder, "orders"), read_table(spark, folder, "lineitem"))


def all_sales(spark: SparkSession, folder: str) -> DataFrame:
    return J.sales(read_table(spark, folder, "orders"), read_table(spark, folder, "lineitem"))


def item_features(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_type").alias("department"),
        F.col("p_brand").alias("category"))


PURCHASES = """purchases AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, CAST(l_quantity AS BIGINT) AS quantity,
         l_extendedprice AS sales_value, o_orderdate AS bought_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

SALES = """sales AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, items_count, o_totalprice AS price, o_orderdate AS order_date
  FROM orders JOIN (SELECT l_orderkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS items_count
                    FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)"""

FEATURES = """count(*) AS c, CAST(sum(items_count) AS BIGINT) AS s1, max(items_count) AS ma1, min(items_count) AS mi1,
  round(sum(price), 2) AS s2, max(price) AS ma2, min(price) AS mi2"""

TOP = """sold_items AS (
  SELECT item_id, CAST(sum(quantity) AS BIGINT) AS quantity FROM purchases
  WHERE sales_value > 0 AND quantity > 0 AND sales_value / quantity >= 1 GROUP BY item_id)"""

BEST = f"""best AS (
  SELECT category, item_id, quantity FROM (
    SELECT p_brand AS category, item_id, quantity,
           row_number() OVER (PARTITION BY p_brand ORDER BY quantity DESC, item_id) AS place
    FROM sold_items JOIN part ON p_partkey = item_id) WHERE place = 1
  ORDER BY quantity DESC, item_id LIMIT {TOP_CATEGORIES})"""


@query(f"""SELECT event_id, CASE WHEN event_id % 10 = 0 THEN '{C.MILESTONE}' ELSE '{C.NO_MILESTONE}' END AS milestone_text
FROM events WHERE event_id % 2 = 0""")
def even_filter_case(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").filter(C.is_multiple("event_id", 2))
    return events.select("event_id", C.milestone("event_id").alias("milestone_text"))


@query("""SELECT p_partkey, p_name, p_type, CAST(length(p_name) AS INTEGER) AS name_length,
  CAST(length(p_type) AS INTEGER) AS type_length
FROM part WHERE length(p_name) = length(p_type)""")
def length_equality(spark: SparkSession, folder: str) -> DataFrame:
    return (read_table(spark, folder, "part").filter(C.same_length("p_name", "p_type"))
            .select("p_partkey", "p_name", "p_type", F.length("p_name").alias("name_length"),
                    F.length("p_type").alias("type_length")))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, strftime(o_orderdate, '%-d/%-m/%Y') AS ordered,
  strftime(l_shipdate, '%-d/%-m/%Y') AS shipped,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days_between
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def date_parse_datediff(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.date_format("o_orderdate", C.DAY_MONTH_YEAR).alias("ordered"))
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.date_format("l_shipdate", C.DAY_MONTH_YEAR).alias("shipped"))
    return lines.join(orders, "l_orderkey").withColumn("days_between", C.days_between("ordered", "shipped"))


@query("""SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def json_decode_flatten(spark: SparkSession, folder: str) -> DataFrame:
    parsed = F.from_json("props", "k int").alias("value")
    return read_table(spark, folder, "events").select("event_id", "event_type", parsed).select(
        "event_id", "event_type", "value.*")


@query(f"""WITH {SALES}, known AS (SELECT user_id, {FEATURES} FROM sales GROUP BY user_id)
SELECT c_custkey AS user_id, coalesce(c, 0) AS c, coalesce(s1, 0) AS s1, coalesce(ma1, 0) AS ma1,
  coalesce(mi1, {C.NO_MINIMUM}) AS mi1, coalesce(s2, 0) AS s2, coalesce(ma2, 0) AS ma2,
  coalesce(mi2, {C.NO_MINIMUM}) AS mi2
FROM customer LEFT JOIN known ON user_id = c_custkey""")
def null_sentinel_fill(spark: SparkSession, folder: str) -> DataFrame:
    users = read_table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    known = A.purchase_features(all_sales(spark, folder), ["user_id"], "items_count", "price")
    filled = A.neutral_features(users.join(known, "user_id", "left"))
    return filled.withColumn("s2", F.round("s2", 2))


@query("""SELECT c_custkey, c_mktsegment, c_acctbal, c_nationkey,
  c_mktsegment IN ('BUILDING', 'MACHINERY') AS in_list, c_acctbal BETWEEN 0 AND 5000 AS in_range
FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') OR c_acctbal BETWEEN 0 AND 5000
   OR c_nationkey = 1 OR c_nationkey = 2""")
def key_in_between_lookup(spark: SparkSession, folder: str) -> DataFrame:
    in_list = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    in_range = F.col("c_acctbal").between(0, 5000)
    one_of = (F.col("c_nationkey") == 1) | (F.col("c_nationkey") == 2)
    return read_table(spark, folder, "customer").filter(in_list | in_range | one_of).select(
        "c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey", in_list.alias("in_list"), in_range.alias("in_range"))


@query("""SELECT event_type, round(avg(event_id), 4) AS avg_event_id, round(avg(user_id), 4) AS avg_user_id,
  round(avg(value), 4) AS avg_value FROM events GROUP BY event_type""")
def group_avg_batch(spark: SparkSession, folder: str) -> DataFrame:
    averages = A.means(read_table(spark, folder, "events"), "event_type")
    return averages.select("event_type", *[F.round(c, 4).alias(c) for c in averages.columns if c != "event_type"])


@query(f"""WITH {SALES} SELECT user_id, c_nationkey AS nation, c_mktsegment AS segment, {FEATURES}
FROM sales JOIN customer ON c_custkey = user_id GROUP BY user_id, c_nationkey, c_mktsegment""")
def user_feature_agg(spark: SparkSession, folder: str) -> DataFrame:
    return user_features(spark, folder).withColumn("s2", F.round("s2", 2))


def user_features(spark: SparkSession, folder: str) -> DataFrame:
    users = read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"))
    # Folded per user before the users' columns are joined on: the join moves one row per user.
    per_user = A.purchase_features(all_sales(spark, folder), ["user_id"], "items_count", "price")
    return users.join(per_user, "user_id")


@query(f"""WITH {SALES} SELECT user_id, {FEATURES} FROM sales GROUP BY user_id""")
def partial_agg_merge(spark: SparkSession, folder: str) -> DataFrame:
    sales = all_sales(spark, folder).withColumn("part", F.when(F.col("order_date") < "1998-01-01", 0).otherwise(1))
    partials = A.purchase_features(sales, ["user_id", "part"], "items_count", "price")
    history, recent = partials.filter("part = 0").drop("part"), partials.filter("part = 1").drop("part")
    return A.merge_features(history.unionByName(recent), "user_id", []).withColumn("s2", F.round("s2", 2))


@query("""SELECT DISTINCT o_custkey AS user_id FROM orders""")
def distinct_users(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").select(F.col("o_custkey").alias("user_id")).distinct()


@query(f"""WITH {PURCHASES} SELECT user_id, count(*) AS n_items,
  string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items
FROM (SELECT DISTINCT user_id, item_id FROM purchases) GROUP BY user_id""")
def user_item_lists(spark: SparkSession, folder: str) -> DataFrame:
    lists = A.item_lists(all_purchases(spark, folder), "user_id", "item_id")
    return lists.select(F.col("user_id").cast("long").alias("user_id"), F.size("own").cast("long").alias("n_items"),
                        F.array_join(F.col("own").cast("array<string>"), ",").alias("items"))


@query("""SELECT 'part' AS source, count(*) AS total_rows, count(DISTINCT p_partkey) AS distinct_id,
  count(DISTINCT p_type) AS distinct_department, count(DISTINCT p_brand) AS distinct_category FROM part""")
def dataset_profile(spark: SparkSession, folder: str) -> DataFrame:
    named = C.lower_names(read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("ID"), F.col("p_type").alias("DEPARTMENT"), F.col("p_brand").alias("CATEGORY")))
    return A.profile(named, ["id", "department", "category"]).select(F.lit("part").alias("source"), "*")


def sold_items(spark: SparkSession, folder: str, bought: DataFrame | None = None) -> DataFrame:
    return R.sold(all_purchases(spark, folder) if bought is None else bought, where=C.unit_price_at_least(F.lit(1), "sales_value", "quantity"))


@query(f"""WITH {PURCHASES}, {TOP}
SELECT * FROM sold_items ORDER BY quantity DESC, item_id LIMIT {TOP_ITEMS}""")
def topk_items(spark: SparkSession, folder: str) -> DataFrame:
    best = R.top(sold_items(spark, folder), "quantity", "item_id", TOP_ITEMS)
    return best.withColumn("quantity", F.round("quantity").cast("long"))


def best_of_categories(spark: SparkSession, folder: str, bought: DataFrame | None = None) -> DataFrame:
    ranked = sold_items(spark, folder, bought).join(item_features(spark, folder), "item_id")
    return R.top(R.best_per_category(ranked, "category"), "quantity", "item_id", TOP_CATEGORIES)


@query(f"""WITH {PURCHASES}, {TOP}, {BEST} SELECT * FROM best""")
def top_item_per_category(spark: SparkSession, folder: str) -> DataFrame:
    return best_of_categories(spark, folder).withColumn("quantity", F.round("quantity").cast("long"))


# SQL: the values of a digest, as sampling.digest has it.
def digest_sql(*keys: str, seed: int = 42) -> str:
    return "md5(concat_ws(':', '" + str(seed) + "', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in keys) + "))"


def percent_sql(*keys: str) -> str:
    return f"CAST('0x' || substr({digest_sql(*keys)}, 1, 8) AS BIGINT) % 100"


TOP_LIST = f"""SELECT 'top_{TOP_CATEGORIES}' AS name,
  string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY quantity DESC, item_id) AS items FROM best"""
RANDOM_LIST = f"""SELECT 'random_{TOP_CATEGORIES}' AS name, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY drawn) AS items
  FROM (SELECT item_id, {digest_sql("item_id")} AS drawn FROM (SELECT DISTINCT l_partkey AS item_id FROM lineitem)
    ORDER BY drawn LIMIT {TOP_CATEGORIES})"""


def random_list(spark: SparkSession, folder: str) -> DataFrame:
    items = read_table(spark, folder, "lineitem").select(F.col("l_partkey").alias("item_id"))
    return R.as_list(S.sample_values(items, "item_id", TOP_CATEGORIES), f"random_{TOP_CATEGORIES}", "item_id", F.col("digest"))


def as_text(listed: DataFrame) -> DataFrame:
    return listed.select("name", F.array_join(F.col("list").cast("array<string>"), ",").alias("items"))


@query(f"""WITH {PURCHASES}, {TOP}, {BEST} {TOP_LIST} UNION ALL {RANDOM_LIST}""")
def baseline_lists(spark: SparkSession, folder: str) -> DataFrame:
    best = R.as_list(best_of_categories(spark, folder), f"top_{TOP_CATEGORIES}", "item_id", -F.col("quantity"))
    return as_text(best.unionByName(random_list(spark, folder)))


@query(RANDOM_LIST)
def random_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(random_list(spark, folder))


@query(f"""SELECT event_id, row_number() OVER (ORDER BY {digest_sql("event_id")}, event_id) - 1 AS place FROM events""")
def shuffled_rows(spark: SparkSession, folder: str) -> DataFrame:
    return S.shuffled(read_table(spark, folder, "events").select("event_id"), "event_id")


@query(f"""SELECT CASE WHEN {percent_sql("l_orderkey")} < 80 THEN 'train' ELSE 'rest' END AS part, count(*) AS n_rows,
  count(DISTINCT l_orderkey) AS n_orders, CAST(sum(l_linenumber) AS BIGINT) AS line_numbers FROM lineitem GROUP BY 1""")
def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    train, rest = S.digest_split(lines, ["l_orderkey"], 80)
    both = train.withColumn("part", F.lit("train")).unionByName(rest.withColumn("part", F.lit("rest")))
    return both.groupBy("part").agg(F.count("*").alias("n_rows"), F.count_distinct("l_orderkey").alias("n_orders"),
                                    F.sum("l_linenumber").alias("line_numbers"))


@query(f"""WITH {PURCHASES}, frequent AS (
  SELECT user_id FROM purchases GROUP BY user_id HAVING sum(quantity) >= 1000)
SELECT event_id, user_id, event_type FROM events WHERE user_id IN (SELECT user_id FROM frequent)""")
def key_semi_join(spark: SparkSession, folder: str) -> DataFrame:
    frequent = (all_purchases(spark, folder).groupBy(F.col("user_id").cast("long").alias("user_id"))
                .agg(F.sum("quantity").alias("n")).filter("n >= 1000"))
    events = read_table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return J.keep_keys(events, frequent, ["user_id"])


def shared_precision(spark: SparkSession, folder: str, bought: DataFrame) -> DataFrame:
    """Each user's precision if everybody is recommended the best items of the leading categories.

    ``bought`` is a stored table: the best items come from it first. Only purchases of these few are made distinct.
    """
    top = [row["item_id"] for row in best_of_categories(spark, folder, bought).collect()]
    users = read_table(spark, folder, "orders").select(F.col("o_custkey").alias("user_id")).distinct()
    recs = users.withColumn("recs", F.array(*[F.lit(i).cast("long") for i in top]))
    return precision(recs, owned(bought.where(F.col("item_id").isin(top))))


PRECISION = """shares AS (
  SELECT u.user_id, avg(CASE WHEN own.item_id IS NULL THEN 0.0 ELSE 1.0 END) AS precision_at_k
  FROM (SELECT DISTINCT o_custkey AS user_id FROM orders) u CROSS JOIN best
  LEFT JOIN (SELECT DISTINCT user_id, item_id FROM purchases) own
    ON own.user_id = u.user_id AND own.item_id = best.item_id
  GROUP BY u.user_id)"""


@query(f"""WITH {PURCHASES}, {TOP}, {BEST}, {PRECISION}
SELECT user_id, round(precision_at_k, 4) AS precision_at_k FROM shares""")
def precision_at_k(spark: SparkSession, folder: str) -> DataFrame:
    bought = materialize(all_purchases(spark, folder).select("user_id", "item_id", "quantity", "sales_value"), "bought")
    shares = shared_precision(spark, folder, bought)
    return shares.select(F.col("user_id").cast("long").alias("user_id"),
                         F.round("precision_at_k", 4).alias("precision_at_k"))


@query(f"""WITH {PURCHASES}, {TOP}, {BEST}, {PRECISION}
SELECT round(avg(precision_at_k), 6) AS avg_precision_at_k FROM shares""")
def mean_precision(spark: SparkSession, folder: str) -> DataFrame:
    mean = A.mean_of(precision_at_k(spark, folder), "precision_at_k")
    return mean.select(F.round("avg_precision_at_k", 6).alias("avg_precision_at_k"))


@query(f"""WITH {PURCHASES}, {TOP}, {BEST}, {PRECISION}
SELECT p.user_id, p.item_id, p.quantity, p.sales_value, round(s.precision_at_k, 4) AS precision_at_k,
  p_type AS department, p_brand AS category
FROM purchases p LEFT JOIN shares s ON s.user_id = p.user_id LEFT JOIN part ON p_partkey = p.item_id""")
def three_way_enrich(spark: SparkSession, folder: str) -> DataFrame:
    bought = materialize(all_purchases(spark, folder).drop("order_id", "bought_at"), "bought")
    shares = shared_precision(spark, folder, bought)
    rows = J.enrich(bought, shares, item_features(spark, folder))
    return rows.select("user_id", "item_id", F.round("quantity").cast("long").alias("quantity"), "sales_value",
                       F.round("precision_at_k", 4).alias("precision_at_k"), "department", "category")


@query("""SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice / l_quantity AS unit_price
FROM lineitem WHERE l_extendedprice > 0 AND l_quantity > 0 AND l_extendedprice / l_quantity >= 1000""")
def unit_prices(spark: SparkSession, folder: str) -> DataFrame:
    dear = read_table(spark, folder, "lineitem").filter(
        C.unit_price_at_least(F.lit(1000), "l_extendedprice", "l_quantity"))
    return dear.select("l_orderkey", "l_partkey", "l_linenumber",
                       (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"))


@query("""SELECT '{' || event_id || ', ' || event_type || ', ' || user_id || '}' AS value, event_id FROM events""")
def struct_text_payload(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").select("event_id", "event_type", "user_id")
    text = messages.struct_payload(events)
    number = F.regexp_extract("value", r"^\{(\d+),", 1).cast("long")
    return text.filter("key is null").select("value", number.alias("event_id"))


@query("""SELECT c_mktsegment, count(*) AS n, max(c_acctbal) AS largest FROM customer
WHERE c_acctbal BETWEEN 0 AND 9000 GROUP BY c_mktsegment""")
def view_sql_scan(spark: SparkSession, folder: str) -> DataFrame:
    return files.sql_over(read_table(spark, folder, "customer"), "customers_seen", """
        SELECT c_mktsegment, count(*) AS n, max(c_acctbal) AS largest FROM customers_seen
        WHERE c_acctbal BETWEEN 0 AND 9000 GROUP BY c_mktsegment""")


@query("""SELECT count(*) AS total_rows, true AS near_half FROM events""")
def random_split_sizes(spark: SparkSession, folder: str) -> DataFrame:
    first, second = S.random_split(read_table(spark, folder, "events").select("event_id"), [0.5, 0.5], seed=42)
    both = first.withColumn("part", F.lit(1)).unionByName(second.withColumn("part", F.lit(0)))
    return both.agg(F.count_distinct("event_id").alias("total_rows"),
                    F.avg("part").between(0.4, 0.6).alias("near_half"))


@query("""SELECT c_custkey AS key, c_name AS text, 'customer' AS source FROM customer
UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier UNION ALL SELECT p_partkey, p_name, 'part' FROM part""")
def union_of_sources(spark: SparkSession, folder: str) -> DataFrame:
    sources = {"customer": ("c_custkey", "c_name"), "supplier": ("s_suppkey", "s_name"), "part": ("p_partkey", "p_name")}
    rows = [read_table(spark, folder, name).selectExpr(f"{key} as key", f"{text} as text", f"'{name}' as source")
            for name, (key, text) in sources.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("""SELECT l_orderkey, o_custkey, count(*) AS n_lines, CAST(sum(l_linenumber) AS BIGINT) AS line_numbers
FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY l_orderkey, o_custkey""")
def catalog_bucketed_join(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and lines saved as catalog tables with equal buckets, joined and grouped where they lie."""
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    buckets = buckets_for(lines.count())
    saved = [files.save_bucketed(df, f"{name}_{uuid.uuid4().hex}", scratch(spark, name), [key], buckets)
             for df, name, key in ((lines, "lines", "l_orderkey"), (orders, "heads", "o_orderkey"))]
    # Both sides are cut alike: merging them moves no row, where a broadcast would move one side to every task.
    joined = saved[0].hint("merge").join(saved[1], F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("l_orderkey", "o_custkey").agg(F.count("*").alias("n_lines"), F.sum("l_linenumber").alias("line_numbers"))


@query("""SELECT event_id, true AS in_range, true AS varied FROM events""")
def random_column(spark: SparkSession, folder: str) -> DataFrame:
    """A random percentage, rounded, beside each row: all of them from 0 to 100, and many different ones."""
    drawn = read_table(spark, folder, "events").select("event_id", C.random_percent(42).alias("percent"))
    varied = drawn.agg(F.count_distinct("percent")).first()[0] > 50
    return drawn.select("event_id", F.col("percent").between(0, 100).alias("in_range"), F.lit(varied).alias("varied"))
