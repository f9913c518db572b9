"""Time the headline queries on one node and print one JSON line.

BENCH_SF_DIR: folder with the tables (default /root/testdata/sf0.1); BENCH_CPUS: local slots (default 8);
BENCH_QUERIES: comma-separated names to time instead of the headline set.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.plans import catalog, models  # noqa: E402
from millrace.session import build_session  # noqa: E402

HEADLINE = [
    "even_filter_case", "json_decode_flatten", "json_encode_roundtrip", "offset_range_scan", "user_feature_agg",
    "partial_agg_merge", "user_item_lists", "top_item_per_category", "precision_at_k", "three_way_enrich",
    "status_split_good_bad", "dedup_tick", "dedup_sliding", "tumbling_count_append", "sliding_count_update",
    "stream_static_inner", "stream_stream_inner", "stream_stream_right", "file_sink_compact", "daily_compaction",
    "keyed_partial_upsert", "keyed_delete", "segment_classifier", "stream_segment_score", "als_recommend",
]


def timed(run) -> tuple[float, object]:
    started = time.perf_counter()
    result = run()
    return round(time.perf_counter() - started, 3), result


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.driver.extraJavaOptions": "-XX:+UseParallelGC"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE

    # Start the JVM's readers and the streaming classes before the clock.
    for warm in ("distinct_users", "memory_sink_query"):
        queries[warm](spark, folder).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in names:
        seconds[name], _ = timed(lambda: queries[name](spark, folder).write.format("noop").mode("overwrite").save())

    result = {"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
              "queries": seconds, "sf": os.path.basename(folder.rstrip("/")), "cpus": int(cpus)}
    if not chosen:
        seconds["stream_recommend"], run = timed(lambda: models.recommended(spark, folder))
        result["value"] = round(sum(seconds.values()), 3)
        rows = spark.read.parquet(f"{run.path}/rows").groupBy("epoch").count().collect()
        figures = spark.read.parquet(f"{run.path}/figures").orderBy("epoch").collect()
        count = dict((r["epoch"], r["count"]) for r in rows)
        result["recommender_batches"] = [
            {"purchases": count[f["epoch"]], "users": f["users"], "seconds": round(f["seconds"], 3)} for f in figures]
        events = spark.read.parquet(f"{folder}/events.parquet").count()
        result["windowed_rows_per_sec"] = round(events / seconds["tumbling_count_append"])
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
