"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
TIME_ZONE = "spark.sql.session.timeZone"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
STATE_PACKAGE = "org.apache.spark.sql.execution.streaming.state."

_local_scratch: dict[str, str] = {}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects; a cluster passes its own master and sizes."""
    builder = SparkSession.builder.appName(app).config("spark.ui.showConsoleProgress", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on (UTC) and the settings streams need; what the caller set stays, and another time
    zone is refused."""
    zone = settings(spark).get(TIME_ZONE, "UTC")
    if zone != "UTC":
        raise ValueError(f"{TIME_ZONE} is {zone}; the library reads zone-less times as UTC")
    spark.conf.set(TIME_ZONE, "UTC")
    # State on local disk instead of the JVM heap, and only the changes uploaded per batch.
    if spark.conf.get(STATE_STORE).endswith(".HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_STORE, STATE_PACKAGE + "RocksDBStateStoreProvider")
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        # Row counts cost a read per write.
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
        # One store per partition of a stream-stream join instead of four.
        spark.conf.set("spark.sql.streaming.join.stateFormatVersion", "3")
    return spark


def settings(spark: SparkSession) -> dict[str, str]:
    """What has been set in this session; defaults are not in it."""
    return dict(spark.conf.getAll)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own: on a cluster the
    executors would not see it.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not is_local(spark):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="millrace-")
        root = _local_scratch[app]
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df, label: str, **options: str):
    """Write a frame to the scratch folder and read it back: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
