import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import plan_of, rows
from millrace.plans.catalog import queries
from millrace.session import scratch
from millrace.sources import files, messages
from millrace.sources.tables import naive, read_table, stream_table, zoned_schema
from millrace.streaming import replay, sinks
from millrace.streaming.run import ALL_AVAILABLE, finish

IRIS = "sepalLength float, species string"


def sent(spark, n, topic="t"):
    df = spark.range(n).select(F.col("id"), F.concat(F.lit("row "), "id").alias("text"),
                               F.timestamp_micros(F.col("id") * 1_000_001).alias("at"))
    return df, messages.to_messages(df, topic, "at")


def test_messages_round_trip(spark):
    df, found = sent(spark, 50)
    assert found.columns == ["key", "value", "topic", "timestamp"] and found.where("key is not null or topic <> 't'").count() == 0
    assert rows(messages.parse_payload(found, df.schema)) == rows(df)
    assert rows(messages.parse_payload(found, df.schema, "timestamp").where("at <> timestamp")) == []


def test_topics_of_a_column(spark):
    df, found = sent(spark, 30, F.concat(F.lit("t"), F.col("id") % 3))
    two = messages.parse_payload(messages.of_topics(found, "t0", "t2"), df.schema, "topic")
    assert sorted((r["id"], r["topic"]) for r in two.collect()) == [(i, f"t{i % 3}") for i in range(30) if i % 3 != 1]


def test_bad_json_gives_nulls_and_null_fields_are_left_out(spark):
    df = spark.createDataFrame([(b'  {"sepalLength": 5.1, "species": "setosa"}',), (b"no json",)], "value binary")
    assert rows(messages.parse_payload(df, IRIS).select("species")) == [("setosa",), (None,)]
    payload = messages.json_payload(spark.sql("select 1 as a, cast(null as string) as b")).first()
    assert payload["key"] is None and json.loads(payload["value"]) == {"a": 1}
    assert messages.struct_payload(spark.sql("select 0 as a, 'error' as b, 1.5D as c")).first()["value"] == "{0, error, 1.5}"


def test_broker_options(spark):
    options = messages.broker_options("host:9092", ["a", "b"], {"a": {"0": 10}}, "latest", 5)
    assert options == {"kafka.bootstrap.servers": "host:9092", "subscribe": "a,b", "maxOffsetsPerTrigger": "5",
                       "startingOffsets": '{"a": {"0": 10}}', "endingOffsets": "latest"}


def test_file_stream_needs_a_schema(spark):
    path = scratch(spark, "csv")
    spark.range(2).write.csv(path)
    with pytest.raises(Exception, match="(?i)schema"):
        spark.readStream.format("csv").load(path)


def test_csv_binds_by_position_and_resumes_from_the_checkpoint(spark):
    path = scratch(spark, "csv")
    spark.createDataFrame([("a", "1/1/2000")], "`President` string, `Took office` string").write.option(
        "header", True).csv(path)
    stream = files.stream_files(spark, path, "csv", "President string, Took_office string", header=True)
    run = sinks.Bounded(stream, "csv")
    run.drain()
    spark.createDataFrame([("b", "1/1/2004")], "p string, t string").write.mode("append").option("header", True).csv(path)
    run.drain()
    assert rows(run.revisions()) == [("a", "1/1/2000", 0), ("b", "1/1/2004", 1)]


def test_limit_is_a_maximum(spark):
    path = scratch(spark, "limited")
    for i in range(4):
        replay.land(spark.range(i, i + 1).coalesce(1), path)
    run = sinks.Bounded(files.stream_files(spark, path, "parquet", "id long", max_files=3), "limited")
    run.drain()
    assert rows(run.revisions()) == [(0, 0), (1, 0), (2, 0), (3, 1)]


def test_no_batch_passes_the_limit_of_bytes(spark):
    path = scratch(spark, "limited")
    sizes = [10, 4000, 10, 10, 9000, 10]
    for i, n in enumerate(sizes):
        replay.land(spark.range(n).selectExpr(f"{i} AS file", "id", "sha2(string(id), 256) AS text").coalesce(1), path)
    found = spark.read.parquet(path).select("file", "_metadata.file_size").distinct().collect()
    size = {r["file"]: r["file_size"] for r in found}
    limit = size[1] + size[0] + 1
    run = sinks.Bounded(files.stream_files(spark, path, "parquet", "file int, id long, text string", max_bytes=limit), "limited")
    run.drain()
    batches = {}
    for r in run.revisions().select("epoch", "file").distinct().collect():
        batches.setdefault(r["epoch"], []).append(r["file"])
    # A file above the limit is alone in its batch; the others are taken as long as they fit.
    assert [sorted(batches[e]) for e in sorted(batches)] == [[0, 1], [2, 3], [4], [5]]
    assert all(sum(size[f] for f in b) <= limit or len(b) == 1 for b in batches.values())
    with pytest.raises(ValueError):
        files.stream_files(spark, path, "parquet", "id long", max_files=1, max_bytes=1)


def test_table_streams_and_batch_writers_take_the_limit(spark):
    folder = scratch(spark, "tables")
    for i in range(4):
        replay.land(spark.range(i * 10, i * 10 + 10).coalesce(1), f"{folder}/numbers.parquet")
    run = sinks.Bounded(stream_table(spark, folder, "numbers", max_bytes=1), "split",
                        do=lambda path: sinks.fan_out(path, {"even": lambda b: b.where("id % 2 = 0")}))
    run.drain()
    found = spark.read.parquet(f"{run.path}/even")
    assert rows(found.groupBy("epoch").count()) == [(e, 5) for e in range(4)]


def test_bucketed_catalog_tables_join_and_group_without_a_shuffle(spark):
    left = spark.range(3000).selectExpr("id % 700 AS k", "id AS a")
    right = spark.range(500).selectExpr("id AS k", "id * 2 AS b")
    saved = [files.save_bucketed(df, name, scratch(spark, name), ["k"], 4) for df, name in ((left, "many_rows"), (right, "few_rows"))]
    joined = saved[0].hint("merge").join(saved[1], "k").groupBy("k").agg(F.count("*").alias("n"), F.max("b").alias("b"))
    plan = plan_of(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert rows(joined) == rows(left.join(right, "k").groupBy("k").agg(F.count("*").alias("n"), F.max("b").alias("b")))
    assert rows(spark.table("few_rows")) == rows(right)


def test_other_formats_and_equal_spellings(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    for fmt, options in (("csv", {"sep": ";"}), ("json", {}), ("orc", {}), ("parquet", {})):
        path = scratch(spark, fmt)
        df.write.format(fmt).options(**options).save(path)
        assert rows(files.read_files(spark, path, fmt, df.schema, **options), "a", "b") == rows(df)
        assert rows(sinks.collect_files(files.stream_files(spark, path, fmt, df.schema, **options), fmt), "a", "b") == rows(df)
    assert rows(files.read_files(spark, path + "/*.parquet"), "a", "b") == rows(df)


def test_rate_sources(spark):
    assert files.rate_stream(spark, 5).isStreaming
    repeatable = files.rate_per_batch(spark, 10, numPartitions=2)
    query = sinks.each_batch(repeatable, sinks.by_epoch(path := scratch(spark, "rate")), scratch(spark, "c"))
    while not query.lastProgress or query.lastProgress.batchId < 2:
        query.awaitTermination(1)
    query.stop()
    first = sinks.read_epochs(spark, path, repeatable.schema).filter("epoch < 2")
    assert [r["value"] for r in first.orderBy("value").collect()] == list(range(20))


def test_literal_rows_and_sql(spark):
    animals = files.literal_rows(spark, [(11, "Cow", "Big"), (3, "Deer", "Big")], "id int, name string, size string")
    assert rows(files.sql_over(animals, "animals", "select name from animals where id between 4 and 20")) == [("Cow",)]


def test_external_stores_are_reported_when_missing(spark):
    with pytest.raises(Exception):
        files.store_scan(spark, "animals", "k").count()


def test_table_timestamps_are_instants_and_filters_reach_the_scan(spark, sf):
    events = read_table(spark, sf, "events")
    assert dict(events.dtypes)["ts"] == "timestamp"
    assert dict(naive(events).dtypes)["ts"] == "timestamp_ntz"
    plan = plan_of(events.filter("ts < timestamp'2024-01-05'").select("event_id"))
    assert "LessThan(ts" in plan and "props" not in plan


def test_table_streams_from_a_file_and_from_a_folder(spark, sf):
    events = read_table(spark, sf, "events")
    folder = scratch(spark, "tables")
    events.repartition(3).write.parquet(f"{folder}/events.parquet")
    spark.range(5).write.parquet(f"{folder}/other.parquet")
    for place in (sf, folder):
        stream = stream_table(spark, place, "events")
        assert stream.isStreaming and stream.schema == zoned_schema(events.schema)
        assert sinks.collect_files(stream, "table").count() == events.count()


def test_catalog_table(spark):
    spark.range(3).createOrReplaceTempView("order_items")
    assert spark.table("order_items").count() == 3
    with pytest.raises(AnalysisException):
        spark.table("no_such_table")


def test_memory_table_with_extra_column(spark, sf):
    finish(sinks.memory(stream_table(spark, sf, "events"), "seen_events", ALL_AVAILABLE))
    found = spark.sql("select *, current_timestamp() as noticed_at from seen_events where event_type = 'click'")
    assert found.count() == read_table(spark, sf, "events").filter("event_type = 'click'").count()
    assert "noticed_at" in found.columns


def test_offsets_go_on_from_batch_to_batch(spark):
    df = spark.createDataFrame([(i, f"r{i}", i * 1000) for i in range(40)] + [(None, "none", 5)] * 2 + [(7, "r7", 7)],
                               "id long, text string, at long").withColumn("at", F.timestamp_micros("at"))
    path = scratch(spark, "numbered")
    write = messages.numbered_batches(path, "t", "partition", "id", "at")
    cut = [p.withColumn("partition", F.col("id") % 2) for p in replay.number_slices(df, "id", 3)]
    for epoch, batch in ((0, cut[0]), (1, cut[1]), (1, cut[1]), (2, cut[2])):
        write(batch, epoch)
    sent = spark.read.schema(messages.NUMBERED).parquet(path)
    assert rows(sent.select("topic").distinct()) == [("t",)]
    found = rows(messages.parse_payload(sent, "id long, text string", "partition", "offset"), "partition", "offset", "id")
    odd, even = sorted([*range(1, 40, 2), 7]), list(range(0, 40, 2))
    assert found == [*[(0, o, i) for o, i in enumerate(even)], *[(1, o, i) for o, i in enumerate(odd)], (None, 0, None), (None, 1, None)]


@pytest.mark.parametrize("name, held", [("message_sink_stream", lambda o, n: True),
                                        ("offset_range_scan", lambda o, n: n // 4 <= o < n // 2), ("offset_start_stream", lambda o, n: o >= n // 2)])
def test_messages_are_numbered_in_partitions(spark, name, held):
    folder = scratch(spark, "odd-ids")  # ids that do not follow the time, and one twice
    ids = [(i * 7) % 50 * 3 + (i % 5 == 0) for i in range(50)] + [3]
    spark.createDataFrame([(i, i % 4, n) for n, i in enumerate(ids)], "event_id long, user_id long, n long").select(
        "event_id", F.timestamp_micros(F.col("n") * 1_000_000).alias("ts"), "user_id").write.parquet(f"{folder}/events.parquet")
    expected = []
    for p in {i % 3 for i in ids}:
        own = sorted(i for i in ids if i % 3 == p)
        expected += [(i, i % 4, p, o) for o, i in enumerate(own) if held(o, len(own))]
    assert rows(queries()[name](spark, folder)) == sorted(expected)
