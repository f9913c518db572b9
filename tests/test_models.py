import pytest
from pyspark.sql import functions as F

from helpers import rows
from millrace.ml import recommend as M
from millrace.ml import segments as G
from millrace.operators.aggregates import FEATURES
from millrace.operators.bucketed import write_buckets
from millrace.operators.keyed import KeyedTable
from millrace.plans import models
from millrace.plans.recommendation import recommend_into
from millrace.plans.segment_scoring import TOUCHED, running_features, score_into
from millrace.session import scratch
from millrace.sources import files
from millrace.streaming import replay, sinks

SCHEMA = "user_id long, nation string, segment string, c long, s1 long, ma1 long, mi1 long, s2 double, ma2 double, mi2 double"


def users(spark, n=40):
    return spark.createDataFrame([
        (i, f"n{i % 3}", "big" if i % 2 else "small", 5, 50 if i % 2 else 5, 9 if i % 2 else 1, 1,
         900.0 if i % 2 else 9.0, 90.0, 1.0) for i in range(n)], SCHEMA)


@pytest.fixture(scope="module")
def model(spark):
    path = scratch(spark, "segments")
    G.save_segments(G.train_segments(users(spark), ["nation"], FEATURES), path)
    return G.load_segments(path)


def test_segments_are_learned_and_unseen_values_do_not_fail(spark, model):
    scored = G.score_segments(model, users(spark))
    assert G.match_share(scored).first()["match_share"] == 1.0
    strange = users(spark, 4).withColumn("nation", F.lit("elsewhere")).drop("segment")
    assert {r["category"] for r in G.score_segments(model, strange).collect()} <= {"big", "small", G.UNKNOWN}


def test_scoring_a_batch_twice_counts_once(spark, model):
    history = users(spark, 4).drop("segment").withColumn("c", F.when(F.col("user_id") < 3, F.col("c")))
    known = scratch(spark, "known")
    replay.land(history, known)
    sales = [[(0, 7, 100.0), (3, 2, 5.0)], [(0, 1, 1.0)]]
    frames = [spark.createDataFrame(b, "user_id long, items_count long, price double").coalesce(1) for b in sales]
    folder = scratch(spark, "sales")
    replay.land(frames[0], folder)
    table = KeyedTable(spark, scratch(spark, "users"), "user_id", "bigint",
                       {"nation": "string", **dict(history.select(*FEATURES).dtypes), "segment": "string"})
    table.write(history.withColumn("segment", F.lit(None).cast("string")), 0)
    running = running_features(files.stream_files(spark, known, "parquet", history.schema),
                               files.stream_files(spark, folder, "parquet", frames[0].schema), ["nation"])
    calls = []

    def do(path):
        write = score_into(path, table, model, ["nation"])

        def flaky(batch, epoch):
            calls.append(epoch)
            write(batch, epoch)
            if len(calls) == 2:
                raise RuntimeError("lost after the write")
        return flaky

    bounded = sinks.Bounded(running, "scores", "update", do)
    bounded.drain()
    replay.land(frames[1], folder)
    with pytest.raises(Exception, match="lost after the write"):
        bounded.drain()
    bounded.drain()
    assert calls == [0, 1, 1]
    found = {r["user_id"]: r for r in table.read().collect()}
    assert (found[0]["c"], found[0]["s1"], found[0]["ma1"], found[0]["mi1"]) == (7, 13, 7, 1)
    assert (found[0]["s2"], found[0]["ma2"], found[0]["mi2"], found[0]["nation"]) == (110.0, 100.0, 1.0, "n0")
    assert (found[3]["c"], found[3]["segment"] is not None, found[1]["segment"]) == (1, True, None)
    assert rows(table.rows_of(spark.createDataFrame([(1,)], "user_id long")), "c") == [(5,)]
    assert TOUCHED not in table.columns


def purchases(spark):
    return spark.createDataFrame([(u, i, 1 + (u + i) % 3, 2.0) for u in range(12) for i in range(15) if (u * i) % 4 != 1],
                                 "user_id int, item_id int, quantity int, sales_value double")


def test_recommendations_and_offline_precision(spark):
    bought = purchases(spark)
    path = scratch(spark, "items")
    M.save_items(M.train_items(bought, blocks=2), path)
    model = M.load_items(spark, path)
    recs = M.recommend(model, spark.createDataFrame([(0,), (3,), (99,)], "user_id int"), 5)
    found = {r["user_id"]: r["recs"] for r in recs.collect()}
    assert sorted(found) == [0, 3] and all(len(set(v)) == 5 for v in found.values())
    both = M.or_else(spark.createDataFrame([(0,), (99,)], "user_id int"), recs, [7, 8])
    assert dict(rows(both))[99] == [7, 8]
    own = {(r["user_id"], r["item_id"]) for r in bought.collect()}
    expected = {u: sum((u, i) in own for i in v) / 5 for u, v in found.items()}
    assert {r["user_id"]: round(r["precision_at_k"], 9) for r in M.with_precision(recs, M.owned(bought)).collect()} == expected
    mean = M.offline_precision(model, {"train": bought}, M.owned(bought)).first()
    assert mean["users"] == 12 and 0 <= mean["precision_at_k"] <= 1


def test_best_items_are_searched_once_for_all_parts(spark, monkeypatch):
    """Users of both parts count in both, with the same precision as when each part is searched on its own."""
    bought = purchases(spark)
    model = M.train_items(bought, blocks=2)
    parts = {"train": bought.filter("user_id < 9"), "validation": bought.filter("user_id > 5 or user_id is null"),
             "nobody": bought.filter("user_id > 99")}
    alone = {name: M.precision(M.recommend(model, part), M.owned(bought)).agg(F.avg("precision_at_k"), F.count("*")).first()
             for name, part in parts.items()}
    searches = []
    search = M.best_products
    monkeypatch.setattr(M, "best_products", lambda *a: searches.append(1) or search(*a))
    found = {r["part"]: (r["precision_at_k"], r["users"]) for r in M.offline_precision(model, parts, M.owned(bought)).collect()}
    assert len(searches) == 1
    assert {n: u for n, (_, u) in found.items()} == {"train": 9, "validation": 6, "nobody": 0} == {n: r[1] for n, r in alone.items()}
    assert all(found[n][0] == pytest.approx(alone[n][0]) for n in ("train", "validation")) and found["nobody"][0] is None
    recs = M.recommend(model, bought)
    given = {r["part"]: (r["precision_at_k"], r["users"]) for r in M.offline_precision(model, parts, M.owned(bought), recs=recs).collect()}
    assert given == found and len(searches) == 2


def test_the_offline_query_searches_once(spark, sf, monkeypatch):
    searches = []
    search = M.best_products
    monkeypatch.setattr(M, "best_products", lambda *a: searches.append(1) or search(*a))
    assert rows(models.offline_precision(spark, sf), "part", "is_share", "by_hits") == [
        ("train", True, True), ("validation", True, True)]
    assert len(searches) == 1


def test_repeats_are_merged_to_one_rating(spark):
    bought = purchases(spark)
    once = M.train_items(bought, iterations=2, blocks=2)
    twice = M.train_items(bought.union(bought), iterations=2, blocks=2)
    key = lambda m: {r["id"]: [round(x, 4) for x in r["features"]] for r in m.factors.userFactors.collect()}
    assert key(once) == key(twice)
    assert M.train_items(bought, iterations=1, blocks=2, merge_repeats=False).factors.rank == 10


def test_recommending_for_batches(spark):
    bought = purchases(spark)
    model = M.train_items(bought.filter("user_id < 10"), blocks=2)
    pairs = write_buckets(M.owned(bought), scratch(spark, "owned"), "user_id", 4)
    items = write_buckets(spark.createDataFrame([(i, f"d{i % 2}", f"c{i % 5}") for i in range(14)],
                                                "item_id int, department string, category string"), scratch(spark, "i"), "item_id", 4)
    path = scratch(spark, "out")
    for epoch in (0, 0):
        recommend_into(path, model, pairs, items, [1, 2, 3, 4, 5])(bought, epoch)
    found = spark.read.parquet(f"{path}/rows")
    assert found.count() == bought.count() and found.filter("recs is null or precision_at_k is null").count() == 0
    assert rows(found.filter("user_id = 11").select("recs").distinct()) == [([1, 2, 3, 4, 5],)]
    assert found.filter("item_id = 14 and category is null").count() == found.filter("item_id = 14").count() > 0
    figures = spark.read.parquet(f"{path}/figures").first()
    assert figures["users"] == 12 and figures["seconds"] > 0
    recommend_into(path, model, pairs, items)(bought, 1)
    assert spark.read.parquet(f"{path}/rows").filter("epoch = 1 and recs is null").select("user_id").distinct().count() == 2


def test_ids_beyond_32_bits(spark):
    base = 3_000_000_000
    bought = purchases(spark).selectExpr(f"user_id + {base} AS user_id", f"item_id + {base} AS item_id", "quantity", "sales_value")
    model = M.train_items(bought, blocks=2)
    recs = {r["user_id"]: r["recs"] for r in M.recommend(model, bought.select("user_id"), 3).collect()}
    small = M.recommend(M.train_items(purchases(spark), blocks=2), purchases(spark).select("user_id"), 3)
    assert recs == {r["user_id"] + base: [i + base for i in r["recs"]] for r in small.collect()}


def test_numbers_are_dense_and_in_order(spark):
    ids = spark.range(0, 5000, 7).selectExpr("id * 1000003 AS user_id").unionByName(spark.range(0, 70, 7).selectExpr("id * 1000003 AS user_id"))
    found = sorted((r["user_id"], r["number"]) for r in M.dense_numbers(ids.repartition(9), "user_id").collect())
    assert [n for _, n in found] == list(range(len(found))) and len(found) == 715
