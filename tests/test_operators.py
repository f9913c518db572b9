import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import plan_of, rows
from millrace.functions import columns as C
from millrace.ml.recommend import owned, precision
from millrace.operators import aggregates as A
from millrace.operators import bucketed as B
from millrace.operators import joins as J
from millrace.operators import ranking as R
from millrace.operators import sampling as S
from millrace.operators import skew
from millrace.session import scratch


def sales_rows(n, users=20, items=30, seed=1):
    """Purchases in which user 1 holds a third of all rows."""
    rnd = random.Random(seed)
    return [(1 if rnd.random() < 0.33 else rnd.randrange(users), rnd.randrange(items), rnd.randrange(0, 4),
             float(rnd.randrange(0, 9))) for _ in range(n)]


def sales_frame(spark, n=600):
    return spark.createDataFrame(sales_rows(n), "user_id int, item_id int, quantity int, sales_value double")


def test_means_leave_text_out(spark):
    iris = spark.createDataFrame([("setosa", 5.0, 3.4, "x"), ("setosa", 4.92, 3.4, "y")],
                                 "species string, length double, width double, note string")
    assert rows(A.means(iris, "species")) == [("setosa", 4.96, 3.4)]


def test_partials_of_any_split_merge_to_the_whole(spark):
    sales = sales_frame(spark)
    whole = A.purchase_features(sales, ["user_id"], "quantity", "sales_value")
    parts = A.purchase_features(sales.withColumn("p", F.col("item_id") % 3), ["user_id", "p"], "quantity", "sales_value")
    assert rows(A.merge_features(parts.drop("p"), "user_id", []), *whole.columns) == rows(whole)


def test_neutral_features_change_nothing(spark):
    known = spark.createDataFrame([(1, 2, 5, 4, 1, 9.0, 6.0, 3.0)], "user_id int, c int, s1 int, ma1 int, mi1 int, s2 double, ma2 double, mi2 double")
    empty = spark.createDataFrame([(1,) + (None,) * 7], known.schema)
    merged = A.merge_features(A.neutral_features(known.union(empty)), "user_id", [])
    assert rows(merged, *known.columns) == rows(known)


def test_item_lists_totals_profile(spark):
    sales = sales_frame(spark)
    expected = {}
    for user, item, *_ in sales_rows(600):
        expected.setdefault(user, set()).add(item)
    lists = dict(rows(A.item_lists(sales, "user_id", "item_id")))
    assert lists == {u: sorted(i) for u, i in expected.items()}
    profile = A.profile(sales, ["user_id", "item_id"]).first()
    assert tuple(profile) == (600, len(expected), len({i for s in expected.values() for i in s}))
    assert A.mean_of(sales, "quantity").first()[0] == sum(r[2] for r in sales_rows(600)) / 600


def test_top_items_and_best_per_category_match_a_walk_down_the_list(spark):
    sales = sales_frame(spark)
    features = spark.createDataFrame([(i, f"c{i % 7}") for i in range(30) if i % 9], "item_id int, category string")
    where = C.unit_price_at_least(F.lit(1), "sales_value", "quantity")
    totals = {}
    for _, item, quantity, value in sales_rows(600):
        if quantity > 0 and value > 0 and value / quantity >= 1:
            totals[item] = totals.get(item, 0) + quantity
    ranked = sorted(totals.items(), key=lambda t: (-t[1], t[0]))
    found = R.top_items(sales, 12, where=where)
    assert [tuple(r) for r in found.collect()] == ranked[:12]

    walked, seen = [], set()
    for item, quantity in ranked:
        category = f"c{item % 7}"
        if item % 9 and category not in seen and len(walked) < 5:
            seen.add(category)
            walked.append((category, item, quantity))
    best = R.top(R.best_per_category(R.top_items(sales, 30, where=where).join(features, "item_id"), "category"),
                 "quantity", "item_id", 5)
    assert [tuple(r) for r in best.collect()] == walked
    assert tuple(R.as_list(best, "top_5", "item_id", -F.col("quantity")).first()) == ("top_5", [w[1] for w in walked])


def test_random_splits_are_disjoint_and_complete(spark):
    df = spark.range(5000)
    a, b = S.random_split(df, [0.5, 0.5], seed=3)
    assert a.count() + b.count() == 5000 and a.intersect(b).count() == 0


def test_samples_and_shuffles(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 50)

    def order(values, seed=42):
        return sorted(values, key=lambda v: (hashlib.md5(f"{seed}:{v}".encode()).hexdigest(), v))

    sample = rows(S.sample_values(df, "v", 5), "v")
    assert sample == sorted((v,) for v in order(range(50))[:5]) == rows(S.sample_values(df.repartition(9), "v", 5), "v")
    assert rows(S.sample_values(df, "v", 5, seed=1), "v") == sorted((v,) for v in order(range(50), 1)[:5])
    # The samples of two tables merge to that of both, and a null is no value.
    halves = [S.sample_values(df.where(c), "v", 5) for c in ("v < 30", "v >= 30")]
    assert rows(halves[0].unionByName(halves[1]).orderBy("digest").limit(5), "v") == sample
    assert rows(S.sample_values(spark.createDataFrame([(None,), (3,)], "v int"), "v", 5), "v") == [(3,)]
    mixed = sorted((r["place"], r["id"]) for r in S.shuffled(spark.range(300).repartition(5), "id").collect())
    assert mixed == list(enumerate(order(range(300))))


def test_digest_splits_are_disjoint_complete_and_repeatable(spark):
    df = spark.range(5000)
    first, rest = S.digest_split(df, ["id"], 80)
    assert {r[0] for r in first.collect()} == {
        i for i in range(5000) if int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:8], 16) % 100 < 80}
    assert first.count() + rest.count() == 5000 and first.intersect(rest).count() == 0
    assert rows(S.digest_split(df.repartition(7), ["id"], 80)[0]) == rows(first)


def test_semi_join_keeps_rows_once_and_enrich_keeps_all(spark):
    sales = sales_frame(spark)
    keys = spark.createDataFrame([(1,), (1,), (7,)], "user_id int")
    assert rows(J.keep_keys(sales, keys, ["user_id"])) == sorted(r for r in sales_rows(600) if r[0] in (1, 7))
    per_user = spark.createDataFrame([(1, "a")], "user_id int, u string")
    per_item = spark.createDataFrame([(2, "b")], "item_id int, i string")
    found = J.enrich(sales, per_user, per_item)
    assert found.count() == 600
    assert found.filter("user_id = 1 and item_id = 2 and u = 'a' and i = 'b'").count() == \
        sum(1 for r in sales_rows(600) if r[0] == 1 and r[1] == 2)


def test_heavy_keys_are_few_and_salting_keeps_the_join(spark):
    lines = sales_frame(spark, 900)
    heads = spark.range(20).select(F.col("id").cast("int").alias("user_id"), F.col("id").alias("name"))
    heavy = skew.heavy_keys(lines, ["user_id"], rows_per_salt=100)
    assert [r["user_id"] for r in heavy.collect()] == [1] and heavy.first()["_salts"] >= 3
    salted = skew.scatter(lines, heavy, ["user_id"], ["item_id", "quantity", "sales_value"])
    joined = salted.join(skew.replicate(heads, heavy, ["user_id"]), ["user_id", skew.SALT]).drop(skew.SALT)
    assert rows(joined) == rows(lines.join(heads, "user_id"))
    assert salted.filter("user_id = 1").select(skew.SALT).distinct().count() >= 3
    assert rows(salted.filter("user_id <> 1").select(skew.SALT).distinct()) == [(0,)]


def test_buckets_prune_files_and_lose_nothing(spark):
    sales = sales_frame(spark)
    stored = B.write_buckets(sales, scratch(spark, "buckets"), "user_id", 8)
    keys = spark.createDataFrame([(1,), (5,)], "user_id int")
    near = stored.near(keys)
    assert rows(near.filter("user_id in (1, 5)")) == sorted(r for r in sales_rows(600) if r[0] in (1, 5))
    assert near.count() < 600 and near.columns == sales.columns
    assert (B.buckets_for(0), B.buckets_for(9_000_001), B.buckets_for(10**12)) == (8, 10, 10_000)
    assert re.search(r"PartitionFilters: \[.*bucket", plan_of(near))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9)), max_size=25),
       st.dictionaries(st.integers(0, 4), st.lists(st.integers(0, 9), min_size=1, max_size=5, unique=True), min_size=1))
def test_precision_matches_lists(spark, bought, recs):
    pairs = owned(spark.createDataFrame(bought, "user_id int, item_id int"))
    given_recs = spark.createDataFrame(list(recs.items()), "user_id int, recs array<int>")
    expected = {u: sum((u, i) in set(bought) for i in items) / len(items) for u, items in recs.items()}
    assert {u: round(p, 9) for u, p in rows(precision(given_recs, pairs))} == {u: round(p, 9) for u, p in expected.items()}


def test_aggregates_combine_before_they_shuffle(spark):
    sales = sales_frame(spark)
    ranked = R.best_per_category(sales.withColumn("category", F.col("item_id") % 3), "category")
    for df in (A.purchase_features(sales, ["user_id"], "quantity", "sales_value"), ranked,
               A.item_lists(sales, "user_id", "item_id")):
        plan = plan_of(df)
        assert "partial_" in plan and "Window" not in plan and "Cartesian" not in plan
    assert "TakeOrderedAndProject" in plan_of(R.top_items(sales, 5))


def test_compaction_keeps_null_days_partitions_and_types(spark):
    from millrace.session import scratch
    from millrace.streaming import compaction

    source, target, whole = (scratch(spark, n) for n in ("days", "closed", "whole"))
    frame = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-05"), (3, None)], "id int, day string")
    frame.write.partitionBy("day").parquet(source)
    compaction.compact_closed(spark, source, target, "day", "2024-01-03", frame.schema)
    assert rows(compaction.read_compacted(spark, source, target, "day", "2024-01-03", frame.schema)) == rows(frame)
    compaction.compact(spark, source, whole, schema=frame.schema, partitioned_by=("day",))
    again = spark.read.schema(frame.schema).parquet(whole)
    assert rows(again) == rows(frame) and "day=2024-01-01" in "".join(again.inputFiles())
