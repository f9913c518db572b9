"""Where streams and batches go. Writes by epoch replace their folder, so a repeated batch adds nothing."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.manifest import Manifest
from millrace.session import scratch
from millrace.sources.messages import json_payload, struct_payload
from millrace.streaming.run import ALL_AVAILABLE, finish, start

Each = Callable[[DataFrame, int], None]


def console(df: DataFrame, every: float | str | None = None, mode: str = "append", truncate: bool = False,
            checkpoint: str | None = None) -> StreamingQuery:
    """Print micro-batches, as ``show`` does for a table."""
    writer = df.writeStream.format("console").outputMode(mode).option("truncate", truncate)
    return start(writer.option("checkpointLocation", checkpoint) if checkpoint else writer, every)


def memory(df: DataFrame, name: str, every: float | str | None = None, mode: str = "append") -> StreamingQuery:
    """Keep results as a table in the driver: for tests, and for reports of a few rows only."""
    return start(df.writeStream.format("memory").queryName(name).outputMode(mode), every)


def files(df: DataFrame, path: str, checkpoint: str, every: float | str | None = None,
          fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append to files, each row once: the folder's log names the files that count."""
    writer = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    return start(writer.partitionBy(*partition_by) if partition_by else writer, every)


def messages(df: DataFrame, servers: str, topic: str, checkpoint: str, every: float | str | None = None,
             as_json: bool = True) -> StreamingQuery:
    """Send rows to a topic as JSON objects, or as plain struct text."""
    payload = json_payload(df) if as_json else struct_payload(df)
    return start(payload.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
                 .option("topic", topic).option("checkpointLocation", checkpoint), every)


def each_batch(df: DataFrame, do: Each, checkpoint: str, every: float | str | None = None,
               mode: str = "append") -> StreamingQuery:
    """Call ``do(batch, epoch)`` for every micro-batch. It may run twice for one epoch after a failure."""
    return start(df.writeStream.foreachBatch(do).outputMode(mode).option("checkpointLocation", checkpoint), every)


# ---- what to do with a batch

def by_epoch(path: str) -> Each:
    """Each batch in its own folder ``epoch=<n>``."""
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return write


def read_epochs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema, T.StructField("epoch", T.LongType())])).parquet(path)


def fan_out(path: str, parts: Mapping[str, Callable[[DataFrame], DataFrame]]) -> Each:
    """Split each batch into named parts, written side by side. The batch is computed once."""
    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for name, part in parts.items():
                part(batch).write.mode("overwrite").parquet(f"{path}/{name}/epoch={epoch}")
        finally:
            batch.unpersist()

    return write


def write_stamped(df: DataFrame, path: str, stamp: str) -> None:
    """One run's rows in the partition ``p_date=<stamp>``; the same run again replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/p_date={stamp}")


def stamped(path: str, stamp_of: Callable[[int], str]) -> Each:
    """As :func:`write_stamped`, for each micro-batch. The stamp follows from the epoch, not from the clock."""
    return lambda batch, epoch: write_stamped(batch, path, stamp_of(epoch))


def run_stamp(spark: SparkSession, path: str, run: str, clock: Callable[[], str]) -> str:
    """The stamp of a named batch run. Its first start takes it from the clock and registers it; when the run is started
    again, also after a failure, it gets the registered one."""
    registry = Manifest(spark, f"{path}/_runs/{run}")
    return registry.change(lambda state: state or {"stamp": clock()})["stamp"]


def write_run(df: DataFrame, path: str, run: str, clock: Callable[[], str]) -> str:
    """One batch run's rows in a partition of its own, ``p_date=<stamp>``; returns the stamp. The same run again replaces
    its rows, whatever the clock says by then."""
    stamp = run_stamp(df.sparkSession, path, run, clock)
    write_stamped(df, path, stamp)
    return stamp


def read_stamped(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema, T.StructField("p_date", T.StringType())])).parquet(path)


# ---- bounded runs

class Bounded:
    """A query run over what is there, again and again, always from the same checkpoint."""

    def __init__(self, df: DataFrame, label: str, mode: str = "append", do: Callable[[str], Each] = by_epoch):
        self.df, self.mode = df, mode
        self.path = scratch(df.sparkSession, label)
        self.checkpoint = scratch(df.sparkSession, f"{label}-checkpoint")
        self.do = do(self.path)

    def drain(self) -> StreamingQuery:
        return finish(each_batch(self.df, self.do, self.checkpoint, ALL_AVAILABLE, self.mode))

    def revisions(self) -> DataFrame:
        return read_epochs(self.df.sparkSession, self.path, self.df.schema)

    def latest(self, *keys: str) -> DataFrame:
        """The last revision of each key (update mode)."""
        rest = [c for c in self.df.columns if c not in keys]
        last = F.max_by(F.struct(*rest), "epoch").alias("_last")
        return self.revisions().groupBy(*keys).agg(last).select(*keys, "_last.*")

    def last_epoch(self) -> DataFrame:
        """The rows of the last batch (complete mode)."""
        rows = self.revisions()
        last = rows.agg(F.max("epoch")).first()[0]
        return rows.filter(F.col("epoch") == F.lit(last)).drop("epoch")


def collect_files(df: DataFrame, label: str) -> DataFrame:
    """Run a stream over all available input into files, and read these."""
    spark = df.sparkSession
    path = scratch(spark, label)
    finish(files(df, path, scratch(spark, f"{label}-checkpoint"), ALL_AVAILABLE))
    return spark.read.schema(df.schema).parquet(path)
