"""Streaming queries, each over whole tables: parsed, deduplicated, windowed, joined, written and compacted."""

from __future__ import annotations

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import ranking
from millrace.operators.skew import heavy_keys
from millrace.plans.registry import query
from millrace.session import materialize, scratch
from millrace.sources import files, messages
from millrace.sources.tables import read_table, stream_table
from millrace.streaming import compaction, dedup, joins, replay, sinks, windows
from millrace.streaming.run import ALL_AVAILABLE, finish, keep_alive, watch

SLICES = 3
PARTITIONS = 3  # of a numbered topic
LIMITED = 6
MOST_BYTES = 1 << 36  # of a micro-batch over a whole table
DAY = "1 day"
# The remarks on good and bad orders, and descriptions of some event types.
TOO_SLOW, VERY_FAST = "too slow", "very fast delivery"
DESCRIPTIONS = [("click", "pressed something"), ("view", "looked at a page"), ("purchase", "bought something")]


def landed(spark: SparkSession, frames: list[DataFrame], label: str) -> tuple[str, DataFrame]:
    """A folder with the first frame's files, and the stream that reads the folder."""
    folder = scratch(spark, label)
    replay.land(frames[0], folder)
    return folder, files.stream_files(spark, folder, "parquet", frames[0].schema)


def replayed(df: DataFrame, time: str, label: str, build, mode: str = "append", n: int = SLICES,
             order: list[int] | None = None, do=sinks.by_epoch) -> sinks.Bounded:
    """Run ``build(stream)`` over the table arriving slice by slice; each slice is one micro-batch."""
    spark = df.sparkSession
    cut = replay.time_slices(df, time, n)
    cut = [cut[i] for i in order or range(n)]
    folder, stream = landed(spark, cut, f"{label}-input")
    run = sinks.Bounded(build(stream), label, mode, do)
    run.drain()
    replay.arrive([(cut[1:], folder)], run.drain)
    return run


# ---- files and messages

@query("""SELECT p_partkey, p_name, p_type FROM part""")
def csv_stream_scan(spark: SparkSession, folder: str) -> DataFrame:
    parts = read_table(spark, folder, "part").select("p_partkey", "p_name", "p_type")
    path = scratch(spark, "part-csv")
    parts.write.option("header", True).csv(path)
    return sinks.collect_files(files.stream_files(spark, path, "csv", parts.schema, header=True), "csv-stream")


@query("""SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def csv_batch_scan(spark: SparkSession, folder: str) -> DataFrame:
    customers = read_table(spark, folder, "customer")
    path = scratch(spark, "customer-csv")
    customers.write.option("sep", ";").csv(path)
    return files.read_files(spark, path, "csv", customers.schema, sep=";")


@query("""SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def json_stream_scan(spark: SparkSession, folder: str) -> DataFrame:
    customers = read_table(spark, folder, "customer")
    path = scratch(spark, "customer-json")
    customers.write.json(path)
    return sinks.collect_files(files.stream_files(spark, path, "json", customers.schema), "json-stream")


@query("""SELECT * FROM orders""")
def orc_batch_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "orders-orc")
    read_table(spark, folder, "orders").write.orc(path)
    return files.read_files(spark, path, "orc")


@query(f"""SELECT e.*, CAST(least(floor(({LIMITED} * (epoch_us(ts) - low)) / (high - low)), {LIMITED - 1}) AS BIGINT) AS epoch, true AS within_limit
FROM events e, (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM events)""")
def rate_limited_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events in files of one time slice each, read under a limit of bytes that the largest file reaches: one file in each
    micro-batch, in order of arrival."""
    events = read_table(spark, folder, "events")
    path = scratch(spark, "events-files")
    for piece in replay.time_slices(events, "ts", LIMITED):
        replay.land(piece.coalesce(1), path)
    limit = compaction.file_sizes(spark, path).agg(F.max("length")).first()[0]
    limited = files.stream_files(spark, path, "parquet", events.schema, max_bytes=limit)
    run = sinks.Bounded(limited.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")), "limited")
    run.drain()
    rows = run.revisions()
    bytes_read = rows.select("epoch", "file", "size").distinct().groupBy("epoch").agg((F.sum("size") <= limit).alias("within_limit"))
    return rows.drop("file", "size").join(bytes_read, "epoch")


@query("""SELECT * FROM events""")
def json_encode_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "messages")
    events = read_table(spark, folder, "events")
    messages.to_messages(events, "events", "ts").write.parquet(path)
    return messages.parse_payload(spark.read.parquet(path), events.schema)


def message_stream(spark: SparkSession, folder: str) -> tuple[DataFrame, T.StructType]:
    """Events streamed as messages, one topic per event type, and what a payload holds."""
    events = stream_table(spark, folder, "events")
    return messages.to_messages(events, F.col("event_type"), "ts"), events.schema


NUMBERED = f"""SELECT event_id, user_id, event_id % {PARTITIONS} AS "partition",
  row_number() OVER (PARTITION BY event_id % {PARTITIONS} ORDER BY event_id) - 1 AS "offset" FROM events"""
ENDS = f"""(SELECT "partition" AS p, max("offset") + 1 AS last FROM ({NUMBERED}) GROUP BY 1)"""
TOPIC_PARTITION = f"event_id % {PARTITIONS}"


def numbered(parsed: DataFrame) -> DataFrame:
    return parsed.select("event_id", "user_id", "partition", "offset")


def numbered_messages(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, T.StructType]:
    """Events as messages with partition and offset, stored; the offset after the last of each partition; and what a payload
    holds."""
    events = read_table(spark, folder, "events")
    placed = ranking.in_groups(events.withColumn("partition", F.expr(TOPIC_PARTITION)), "partition", [F.asc("event_id")], "offset")
    sent = materialize(messages.to_messages(placed, "events", "ts", "partition", "offset"), "messages")
    return sent, sent.groupBy("partition").agg((F.max("offset") + 1).alias("last")), events.schema


@query(NUMBERED)
def message_sink_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events arriving in three batches, in order of their ids, are sent as messages whose offsets go on from batch to batch,
    and these are read as a stream."""
    events = read_table(spark, folder, "events")
    cut = replay.number_slices(events, "event_id", SLICES)
    source, stream = landed(spark, cut, "sent-input")
    run = sinks.Bounded(stream.withColumn("partition", F.expr(TOPIC_PARTITION)), "sent",
                        do=lambda path: messages.numbered_batches(path, "events", "partition", "event_id", "ts"))
    run.drain()
    replay.arrive([(cut[1:], source)], run.drain)
    sent = files.stream_files(spark, f"{run.path}/*", "parquet", messages.NUMBERED)
    return numbered(sinks.collect_files(messages.parse_payload(sent, events.schema, "partition", "offset"), "received"))


@query(f"""SELECT n.* FROM ({NUMBERED}) n JOIN {ENDS} ON "partition" = p
WHERE "offset" >= CAST(floor(last / 4) AS BIGINT) AND "offset" < CAST(floor(last / 2) AS BIGINT)""")
def offset_range_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The second quarter of every partition's messages, by offset."""
    sent, ends, schema = numbered_messages(spark, folder)
    chosen = sent.join(ends, "partition").where(
        (F.col("offset") >= F.floor(F.col("last") / 4)) & (F.col("offset") < F.floor(F.col("last") / 2)))
    return numbered(messages.parse_payload(chosen, schema, "partition", "offset"))


@query(f"""SELECT n.* FROM ({NUMBERED}) n JOIN {ENDS} ON "partition" = p
WHERE "offset" >= CAST(floor(last / 2) AS BIGINT)""")
def offset_start_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of each partition's messages from the middle on."""
    sent, ends, schema = numbered_messages(spark, folder)
    path = scratch(spark, "sent")
    sent.write.parquet(path)
    stream = files.stream_files(spark, path, "parquet", sent.schema).join(materialize(ends, "ends"), "partition")
    chosen = stream.where(F.col("offset") >= F.floor(F.col("last") / 2))
    return numbered(sinks.collect_files(messages.parse_payload(chosen, schema, "partition", "offset"), "from-offset"))


@query("""SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-16 00:00:00'""")
def latest_start_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of the messages from a time on."""
    sent, schema = message_stream(spark, folder)
    return sinks.collect_files(messages.parse_payload(sent.where(F.col("timestamp") >= F.lit("2024-01-16").cast("timestamp")), schema), "from-time")


@query("""SELECT event_type AS topic, event_id, user_id, ts FROM events
WHERE event_type IN ('click', 'purchase')""")
def multi_topic_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Two topics of a stream that has one for every event type."""
    sent, schema = message_stream(spark, folder)
    parsed = messages.parse_payload(messages.of_topics(sent, "click", "purchase"), schema, "topic")
    return sinks.collect_files(parsed.select("topic", "event_id", "user_id", "ts"), "two-topics")


# ---- batches by epoch

@query(f"""SELECT CASE WHEN o_orderstatus = 'F' THEN 'good' ELSE 'bad' END AS job, o_orderkey, o_orderstatus,
  CASE WHEN o_orderstatus = 'F' THEN NULL ELSE '{TOO_SLOW}' END AS reason,
  CASE WHEN o_orderstatus = 'F' THEN '{VERY_FAST}' END AS delivery_time
FROM orders WHERE o_orderstatus IS NOT NULL""")
def status_split_good_bad(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    columns = ["o_orderkey", "o_orderstatus"]
    parts = {
        "good": lambda b: b.filter(status == "F").select(*columns, F.lit(VERY_FAST).alias("delivery_time")),
        "bad": lambda b: b.filter(status != "F").select(*columns, F.lit(TOO_SLOW).alias("reason")),
    }
    run = sinks.Bounded(stream_table(spark, folder, "orders", max_bytes=MOST_BYTES), "split", do=lambda path: sinks.fan_out(path, parts))
    run.drain()
    good = sinks.read_epochs(spark, f"{run.path}/good",
                             T.StructType.fromDDL("o_orderkey bigint, o_orderstatus string, delivery_time string"))
    bad = sinks.read_epochs(spark, f"{run.path}/bad",
                            T.StructType.fromDDL("o_orderkey bigint, o_orderstatus string, reason string"))
    both = good.withColumn("job", F.lit("good")).unionByName(bad.withColumn("job", F.lit("bad")),
                                                             allowMissingColumns=True)
    return both.select("job", *columns, "reason", "delivery_time")


@query("""SELECT event_type, count(*) AS n, true AS has_time FROM events WHERE event_type <> 'error'
GROUP BY event_type""")
def memory_sink_query(spark: SparkSession, folder: str) -> DataFrame:
    # The driver holds one row per event type, whatever the number of events.
    name = "event_totals"
    counts = stream_table(spark, folder, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    finish(sinks.memory(counts, name, ALL_AVAILABLE, "complete"))
    return spark.sql(f"""SELECT event_type, n, noticed_at IS NOT NULL AS has_time
        FROM (SELECT *, current_timestamp() AS noticed_at FROM {name} WHERE event_type <> 'error')""")


@query("""SELECT *, '00000000000000' AS p_date FROM events""")
def stamped_partitions(spark: SparkSession, folder: str) -> DataFrame:
    events = stream_table(spark, folder, "events")
    run = sinks.Bounded(events, "stamped", do=lambda path: sinks.stamped(path, lambda epoch: f"{epoch:014d}"))
    run.drain()
    return sinks.read_stamped(spark, run.path, events.schema)


@query("""SELECT *, '20240102000000' AS p_date FROM orders WHERE o_orderdate < DATE '1998-01-01'
UNION ALL SELECT *, '20240103000000' FROM orders WHERE o_orderdate >= DATE '1998-01-01'""")
def batch_run_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Two batch runs, each in the partition of its stamp. The first is started twice, with other rows at first, and keeps
    the stamp of its first start."""
    orders = read_table(spark, folder, "orders")
    path = scratch(spark, "runs")
    early = F.col("o_orderdate") < "1998-01-01"
    sinks.write_run(orders, path, "early", lambda: "20240102000000")
    sinks.write_run(orders.where(~early), path, "late", lambda: "20240103000000")
    sinks.write_run(orders.where(early), path, "early", lambda: "20240104000000")
    return sinks.read_stamped(spark, path, orders.schema)


@query("""SELECT * FROM events""")
def file_sink_compact(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    cut = replay.time_slices(events, "ts", SLICES)
    path, checkpoint, compacted = (scratch(spark, label) for label in ("sink", "sink-checkpoint", "compacted"))
    source, stream = landed(spark, cut, "sink-input")

    def drain() -> None:
        finish(sinks.files(stream, path, checkpoint, ALL_AVAILABLE))

    drain()
    replay.arrive([(cut[1:], source)], drain)
    compaction.compact(spark, path, compacted)
    return spark.read.schema(events.schema).parquet(compacted)


@query("""SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events""")
def daily_compaction(spark: SparkSession, folder: str) -> DataFrame:
    events = stream_table(spark, folder, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    path, checkpoint, compacted = (scratch(spark, label) for label in ("daily", "daily-checkpoint", "daily-compact"))
    finish(sinks.files(events, path, checkpoint, ALL_AVAILABLE, partition_by=("day",)))
    today = spark.read.schema(events.schema).parquet(path).agg(F.max("day")).first()[0]
    compaction.compact_closed(spark, path, compacted, "day", today, events.schema)
    return compaction.read_compacted(spark, path, compacted, "day", today, events.schema).select(*events.columns)


# ---- deduplication. Which of several rows is kept is open, so results are compared on their keys.

def daily_windows(column: str = "ts", width: int = 24, slide: int = 24) -> str:
    """SQL: one row per event and window it falls in."""
    hour = 3600 * 1000000
    return f"""(SELECT e.*, make_timestamp(CAST((floor(epoch_us({column}) / {slide * hour}) - k) * {slide * hour}
                  AS BIGINT)) AS window_start, make_timestamp(CAST((floor(epoch_us({column}) / {slide * hour}) - k)
                  * {slide * hour} + {width * hour} AS BIGINT)) AS window_end
                FROM events e CROSS JOIN range({width // slide}) r(k))"""


DAILY, HALF_DAYS = daily_windows(), daily_windows(slide=12)
CLOSED = "window_end <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)"


def seen(df: DataFrame) -> DataFrame:
    run = sinks.Bounded(df, "seen", "update")
    run.drain()
    return run.revisions().drop("epoch")


@query("""SELECT DISTINCT event_type, ts FROM events""")
def dedup_tick(spark: SparkSession, folder: str) -> DataFrame:
    events = repeated_events(spark, folder).withWatermark("ts", DAY)
    return seen(dedup.first_seen(events, ["event_type", "ts"]))


def repeated_events(spark: SparkSession, folder: str) -> DataFrame:
    """The event stream with every event coming twice."""
    events = stream_table(spark, folder, "events")
    return events.unionByName(stream_table(spark, folder, "events"))


def dedup_in_windows(spark: SparkSession, folder: str, slide: str | None) -> DataFrame:
    events = windows.windowed(stream_table(spark, folder, "events"), "ts", DAY, DAY, slide)
    return windows.flat(seen(dedup.first_seen(events, ["event_type", windows.WINDOW])))


@query(f"""SELECT DISTINCT event_type, window_start, window_end FROM {DAILY}""")
def dedup_tumbling(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_in_windows(spark, folder, None)


@query(f"""SELECT DISTINCT event_type, window_start, window_end FROM {HALF_DAYS}""")
def dedup_sliding(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_in_windows(spark, folder, "12 hours")


@query("""SELECT DISTINCT event_id FROM events""")
def dedup_within_watermark(spark: SparkSession, folder: str) -> DataFrame:
    kept = dedup.drop_repeats_lately(repeated_events(spark, folder), ["event_id"], "ts", DAY)
    return sinks.collect_files(kept, "dedup").select("event_id")


@query("""SELECT * FROM events""")
def dedup_message_ids(spark: SparkSession, folder: str) -> DataFrame:
    events = repeated_events(spark, folder).withWatermark("ts", DAY)
    return sinks.collect_files(dedup.drop_repeats(events, ["event_id", "ts"]), "dedup")


@query("""SELECT DISTINCT user_id, event_type FROM events""")
def dedup_global(spark: SparkSession, folder: str) -> DataFrame:
    run = replayed(read_table(spark, folder, "events").select("ts", "user_id", "event_type"), "ts", "global",
                   lambda s: dedup.first_seen(s, ["user_id", "event_type"]), "update")
    return run.revisions().drop("epoch")


# ---- windowed rows and counts

@query(f"""SELECT window_start, window_end, event_id, event_type FROM {HALF_DAYS}""")
def sliding_window_rows(spark: SparkSession, folder: str) -> DataFrame:
    events = windows.windowed(stream_table(spark, folder, "events"), "ts", DAY, DAY, "12 hours")
    return sinks.collect_files(windows.flat(events.select(windows.WINDOW, "event_id", "event_type")), "windows")


@query(f"""SELECT epoch, event_type, count(*) AS n, round(avg(value), 4) AS avg_value FROM (
  SELECT *, CAST(least(floor(({SLICES} * (epoch_us(ts) - low)) / (high - low)), {SLICES - 1}) AS BIGINT) AS epoch
  FROM events, (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM events))
GROUP BY epoch, event_type""")
def batch_averages(spark: SparkSession, folder: str) -> DataFrame:
    """The averages of each micro-batch by itself."""
    def averages(path: str) -> sinks.Each:
        write = sinks.by_epoch(path)
        return lambda batch, epoch: write(
            batch.groupBy("event_type").agg(F.count("*").alias("n"), F.avg("value").alias("avg_value")), epoch)

    run = replayed(read_table(spark, folder, "events").select("ts", "event_type", "value"), "ts", "averages", lambda s: s, do=averages)
    found = sinks.read_epochs(spark, run.path, T.StructType.fromDDL("event_type string, n bigint, avg_value double"))
    return found.withColumn("avg_value", F.round("avg_value", 4))


@query(f"""SELECT window_start, window_end, event_type, count(*) AS n FROM {DAILY} WHERE {CLOSED}
GROUP BY window_start, window_end, event_type""")
def tumbling_count_append(spark: SparkSession, folder: str) -> DataFrame:
    counts = windows.window_counts(stream_table(spark, folder, "events"), "ts", DAY, DAY, keys=["event_type"])
    return sinks.collect_files(counts, "append")


@query(f"""SELECT window_start, window_end, count(*) AS n FROM {DAILY} GROUP BY window_start, window_end""")
def tumbling_count_update(spark: SparkSession, folder: str) -> DataFrame:
    run = replayed(read_table(spark, folder, "events").select("ts"), "ts", "update",
                   lambda s: windows.window_counts(s, "ts", DAY, DAY), "update")
    return run.latest("window_start", "window_end")


@query(f"""SELECT window_start, window_end, count(*) AS n FROM {DAILY} GROUP BY window_start, window_end""")
def tumbling_count_complete(spark: SparkSession, folder: str) -> DataFrame:
    counts = windows.window_counts(stream_table(spark, folder, "events"), "ts", DAY, DAY)
    run = sinks.Bounded(counts, "complete", "complete")
    run.drain()
    return run.last_epoch()


@query(f"""SELECT window_start, window_end, count(*) AS n FROM {HALF_DAYS} GROUP BY window_start, window_end""")
def sliding_count_update(spark: SparkSession, folder: str) -> DataFrame:
    counts = windows.window_counts(stream_table(spark, folder, "events"), "ts", DAY, DAY, "12 hours")
    run = sinks.Bounded(counts, "sliding", "update")
    run.drain()
    return run.latest("window_start", "window_end")


@query(f"""SELECT window_start, window_end, count(*) AS n FROM {DAILY}
WHERE {CLOSED} AND epoch_us(ts) >= (SELECT epoch_us(min(ts)) + (epoch_us(max(ts)) - epoch_us(min(ts))) / 4 FROM events)
GROUP BY window_start, window_end""")
def late_rows_dropped(spark: SparkSession, folder: str) -> DataFrame:
    run = replayed(read_table(spark, folder, "events").select("ts"), "ts", "late",
                   lambda s: windows.window_counts(s, "ts", DAY, DAY), n=4, order=[1, 2, 3, 0])
    return run.revisions().drop("epoch")


# ---- joins

@query("""SELECT event_id, user_id, event_type, ts, c_name, c_mktsegment FROM events JOIN customer
ON c_custkey = user_id""")
def stream_static_inner(spark: SparkSession, folder: str) -> DataFrame:
    events = stream_table(spark, folder, "events").select("event_id", "user_id", "event_type", "ts")
    users = read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    return sinks.collect_files(joins.with_table(events, users, "user_id"), "static-inner")


@query("""SELECT event_type, event_id, CASE event_type WHEN 'click' THEN 'pressed something'
  WHEN 'view' THEN 'looked at a page' WHEN 'purchase' THEN 'bought something' END AS description FROM events""")
def stream_static_left(spark: SparkSession, folder: str) -> DataFrame:
    known = files.literal_rows(spark, DESCRIPTIONS, "event_type string, description string")
    events = stream_table(spark, folder, "events").select("event_type", "event_id")
    return sinks.collect_files(joins.with_table(events, known, "event_type", "left"), "static-left")


SHARED = "52 weeks"
SHARED_US = 364 * 24 * 3600 * 1000000
SPANS = f"""heads AS (SELECT o_orderkey AS order_id, o_custkey AS user_id,
    CAST(floor(epoch_us(o_orderdate) / {SHARED_US}) AS BIGINT) AS w FROM orders),
  lines AS (SELECT l_orderkey AS order_id, l_partkey AS item_id, l_linenumber AS line,
    CAST(floor(epoch_us(l_shipdate) / {SHARED_US}) AS BIGINT) AS w FROM lineitem)"""
WINDOW_ENDS = f"""make_timestamp(w * {SHARED_US}) AS window_start, make_timestamp((w + 1) * {SHARED_US}) AS window_end"""


def orders_with_lines(spark: SparkSession, folder: str, how: str) -> DataFrame:
    """Orders and their lines as two streams, joined on order and 52-week window."""
    heads = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("ordered_at"))
    lines = read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("item_id"),
        F.col("l_linenumber").alias("line"), F.col("l_shipdate").alias("shipped_at"))
    ranges = [replay.time_range(heads, "ordered_at"), replay.time_range(lines, "shipped_at")]
    bounds = (min(r[0] for r in ranges), max(r[1] for r in ranges))
    cut = [replay.time_slices(heads, "ordered_at", SLICES, bounds),
           replay.time_slices(lines, "shipped_at", SLICES, bounds)]
    heavy = heavy_keys(lines, ["order_id"])
    (left_folder, left), (right_folder, right) = (landed(spark, c, "join-input") for c in cut)
    joined = joins.within_window(left, "ordered_at", right, "shipped_at", ["order_id"], SHARED, "30 days", how,
                                 heavy, ["item_id", "line", "shipped_at"], scratch(spark, "heavy-orders"))
    found = windows.flat(joined.select(windows.WINDOW, "order_id", "user_id", "item_id", "line"))
    run = sinks.Bounded(found, "joined")
    run.drain()
    replay.arrive([(cut[0][1:], left_folder), (cut[1][1:], right_folder)], run.drain)
    return run.revisions().drop("epoch").withColumn("user_id", F.coalesce("user_id", F.lit(-1)))


@query(f"""WITH {SPANS} SELECT {WINDOW_ENDS}, order_id, user_id, item_id, line
FROM heads JOIN lines USING (order_id, w)""")
def stream_stream_inner(spark: SparkSession, folder: str) -> DataFrame:
    return orders_with_lines(spark, folder, "inner")


@query(f"""WITH {SPANS}, seen AS (
  SELECT least((SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem)) - INTERVAL 30 DAY AS mark)
SELECT {WINDOW_ENDS}, order_id, coalesce(user_id, -1) AS user_id, item_id, line
FROM lines LEFT JOIN heads USING (order_id, w)
WHERE user_id IS NOT NULL OR make_timestamp((w + 1) * {SHARED_US}) <= (SELECT mark FROM seen)""")
def stream_stream_right(spark: SparkSession, folder: str) -> DataFrame:
    return orders_with_lines(spark, folder, "right")


def user_days(spark: SparkSession, folder: str, how: str) -> DataFrame:
    """Clicks and purchases of events arriving slice by slice, folded by user and day, and joined."""
    def build(stream: DataFrame) -> DataFrame:
        clicks = stream.where("event_type = 'click'").select("user_id", F.col("ts").alias("clicked_at"))
        bought = stream.where("event_type = 'purchase'").select("user_id", "value", F.col("ts").alias("bought_at"))
        return windows.flat(joins.folds_in_window(
            clicks, "clicked_at", [F.count("*").alias("clicks")], bought, "bought_at",
            [F.count("*").alias("purchases"), F.max("value").alias("largest")], ["user_id"], DAY, DAY, how))

    events = read_table(spark, folder, "events").select("ts", "user_id", "event_type", "value")
    found = replayed(events, "ts", "user-days", build).revisions().drop("epoch")
    return found.withColumn("clicks", F.coalesce("clicks", F.lit(0)))


USER_DAYS = f"""days AS (SELECT window_start, window_end, user_id, count(*) FILTER (event_type = 'click') AS clicks,
  count(*) FILTER (event_type = 'purchase') AS purchases, max(value) FILTER (event_type = 'purchase') AS largest
  FROM {DAILY} GROUP BY window_start, window_end, user_id),
mark AS (SELECT least(max(ts) FILTER (event_type = 'click'), max(ts) FILTER (event_type = 'purchase')) - INTERVAL 1 DAY AS last FROM events)
SELECT window_start, window_end, user_id, clicks, purchases, largest FROM days WHERE window_end <= (SELECT last FROM mark)"""


@query(f"""WITH {USER_DAYS} AND clicks > 0 AND purchases > 0""")
def stream_stream_folded_inner(spark: SparkSession, folder: str) -> DataFrame:
    return user_days(spark, folder, "inner")


@query(f"""WITH {USER_DAYS} AND purchases > 0""")
def stream_stream_folded_right(spark: SparkSession, folder: str) -> DataFrame:
    return user_days(spark, folder, "right")


# ---- sources by the clock, and how queries are started, watched and stopped

@query("""SELECT event_id, event_type, ts FROM events""")
def rate_driven_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """A rate source counts through the event ids, a third of them in each micro-batch, and each number is looked up."""
    events = read_table(spark, folder, "events").select("event_id", "event_type", "ts")
    last = events.agg(F.max("event_id")).first()[0]
    ticks = files.rate_per_batch(spark, last // SLICES + 1, numPartitions=SLICES).select(F.col("value").alias("event_id"))
    path = scratch(spark, "rate")
    query = sinks.each_batch(joins.with_table(ticks, events, "event_id"), sinks.by_epoch(path), scratch(spark, "rate-checkpoint"))
    keep_alive(query, 1, lambda: bool(query.lastProgress) and query.lastProgress.batchId >= SLICES - 1)
    found = sinks.read_epochs(spark, path, events.schema)
    return found.where(F.col("epoch") < SLICES).drop("epoch")


@query("""SELECT how, count(*) AS input_rows, true AS active_at_first, false AS active_at_last, count(*) AS stored_rows
FROM events, (VALUES ('as fast as possible'), ('every second')) AS triggers(how) GROUP BY how""")
def stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    """The event stream under both kinds of trigger: what its progress says, and whether it is active before and after it is
    stopped."""
    rows = []
    for how, every in (("as fast as possible", None), ("every second", 1)):
        path = scratch(spark, "progress")
        query = sinks.each_batch(stream_table(spark, folder, "events"), sinks.by_epoch(path), scratch(spark, "progress-checkpoint"), every)
        query.processAllAvailable()
        read = sum(p.numInputRows for p in query.recentProgress)
        at_first = watch(query)["active"]
        query.stop()
        rows.append((how, read, at_first, watch(query)["active"], spark.read.parquet(path).count()))
    return spark.createDataFrame(rows, "how string, input_rows long, active_at_first boolean, active_at_last boolean, stored_rows long")


@query("""SELECT count(*) AS n, true AS update_refused, true AS append_without_mark_refused FROM events""")
def refused_modes(spark: SparkSession, folder: str) -> DataFrame:
    """Output modes that a stream cannot have: update for a stream-stream right join, append for counts without a watermark."""
    def refused(df: DataFrame, mode: str) -> bool:
        try:
            finish(sinks.each_batch(df, lambda batch, epoch: None, scratch(spark, "refused"), ALL_AVAILABLE, mode))
        except (AnalysisException, StreamingQueryException):
            return True
        return False

    events = stream_table(spark, folder, "events")
    pairs = joins.within_window(events.select("user_id", F.col("ts").alias("a")), "a", events.select("user_id", F.col("ts").alias("b")), "b",
                                ["user_id"], DAY, DAY, "right")
    counts = events.groupBy("event_type").count()
    return read_table(spark, folder, "events").agg(F.count("*").alias("n")).select(
        "n", F.lit(refused(pairs, "update")).alias("update_refused"), F.lit(refused(counts, "append")).alias("append_without_mark_refused"))
