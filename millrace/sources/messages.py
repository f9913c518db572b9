"""Messages: rows as JSON payloads with a topic and a time, and a broker's own batch and streaming reads.

A deployed broker is read with :func:`broker_batch` and :func:`broker_stream`; what its messages hold is parsed by
:func:`parse_payload`, whatever they came from.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.ranking import in_groups

# JSON text keeps microseconds; the format's default would cut them to milliseconds.
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

Offsets = str | Mapping[str, Mapping[str, int]]


# ---- payloads

def json_payload(df: DataFrame) -> DataFrame:
    """Key and value of a message per row: no key, all columns as a JSON object."""
    return df.select(F.lit(None).cast("string").alias("key"), F.to_json(F.struct("*"), JSON_TIMES).alias("value"))


def struct_payload(df: DataFrame) -> DataFrame:
    """As :func:`json_payload`, with the struct's plain text as value."""
    return df.select(F.lit(None).cast("string").alias("key"), F.struct("*").cast("string").alias("value"))


def parse_payload(messages: DataFrame, schema: T.StructType | str, *keep: str) -> DataFrame:
    """Binary value to typed columns, beside the envelope columns named in ``keep``."""
    return (messages
            .select(F.from_json(F.col("value").cast("string"), schema, JSON_TIMES).alias("value"), *keep)
            .select("value.*", *keep))


def to_messages(df: DataFrame, topic: str | Column, time: str, *beside: str) -> DataFrame:
    """Rows as messages: no key, all columns but those of ``beside`` as a JSON object in bytes, the topic (a name, or a
    column), the time, and the columns of ``beside``."""
    topic = F.lit(topic) if isinstance(topic, str) else topic
    own = [c for c in df.columns if c not in beside]
    return df.select(F.lit(None).cast("binary").alias("key"), F.to_json(F.struct(*own), JSON_TIMES).cast("binary").alias("value"),
                     topic.alias("topic"), F.col(time).cast("timestamp").alias("timestamp"), *beside)


NUMBERED = "key binary, value binary, topic string, timestamp timestamp, partition long, offset long"


def numbered_batches(path: str, topic: str, partition: str, order: str, time: str):
    """For ``sinks.each_batch``: each batch's messages in its own folder, with their partition (a column of the rows) and offset
    there. Offsets go on where earlier epochs ended; a repeated epoch sees the same ends and replaces its folder."""
    def write(batch: DataFrame, epoch: int) -> None:
        placed = in_groups(batch, partition, [F.asc(order)], "offset")
        if epoch > 0:
            earlier = batch.sparkSession.read.schema(f"{NUMBERED}, epoch long").parquet(path).where(F.col("epoch") < epoch)
            ends = earlier.groupBy(F.col("partition").alias("_of")).agg((F.max("offset") + 1).alias("_start"))
            placed = placed.join(ends, F.col(partition).eqNullSafe(F.col("_of")), "left").withColumn(
                "offset", F.col("offset") + F.coalesce("_start", F.lit(0))).drop("_of", "_start")
        sent = to_messages(placed.withColumnRenamed(partition, "partition"), topic, time, "partition", "offset")
        sent.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return write


def of_topics(messages: DataFrame, *topics: str) -> DataFrame:
    """The messages of some topics."""
    return messages.where(F.col("topic").isin(*topics))


# ---- a deployed broker

def broker_options(servers: str, topics: list[str], starting: Offsets | None = None,
                   ending: Offsets | None = None, max_offsets: int | None = None) -> dict[str, str]:
    """Reader options for the ``kafka`` format."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics)}
    for name, value in (("startingOffsets", starting), ("endingOffsets", ending)):
        if value is not None:
            options[name] = value if isinstance(value, str) else json.dumps(value)
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def broker_batch(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("kafka").options(**broker_options(**options)).load()


def broker_stream(spark: SparkSession, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**broker_options(**options)).load()


def broker_write(payload: DataFrame, servers: str, topic: str) -> None:
    """Batch write of ``(key, value)`` rows to a topic."""
    (payload.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save())
