"""A keyed table: one current row per key, from immutable slices of changes.

Every write puts its changes, folded to one row per key, in a folder of its own, and then names the folder for its epoch
in the table's manifest. Writing the same epoch again names another folder, so a repeated micro-batch changes nothing. A
read folds the slices of the last version. Each value carries the version that set it, which makes folding independent of
order and grouping: raw changes, slices and a compacted base all go through :func:`fold`.

Folded rows have the key, ``_written`` and ``_deleted`` (the last version that wrote or removed the row),
and per value column a struct ``(version, value)`` that is null while nothing was set.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.bucketed import BUCKET, bucket_of, near_keys, put_buckets
from millrace.operators.manifest import Manifest

SLICE = "slice"  # folder of one write


def mentions(column: str) -> str:
    """Name of the flag telling that a change sets ``column``; an unset column keeps its old value."""
    return f"set_{column}"


def version(epoch: int | str | Column, step: int | str | Column = 0) -> Column:
    def number(v):
        return (F.lit(v) if isinstance(v, int) else F.col(v) if isinstance(v, str) else v).cast("long")

    return F.struct(number(epoch).alias("epoch"), number(step).alias("step"))


def as_changes(df: DataFrame, key: str, columns: list[str], at: Column, deleted: Column | None = None) -> DataFrame:
    """Change rows in folded form. Without a flag column :func:`mentions`, a column counts as set.

    A null that is set replaces the old value; ``deleted`` marks rows that remove their key.
    """
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))

    def cell(name: str) -> Column:
        told = F.col(mentions(name)) if mentions(name) in df.columns else F.lit(True)
        return F.when(told & ~gone, F.struct(at.alias("version"), F.col(name).alias("value"))).alias(name)

    return df.select(key, F.when(~gone, at).alias("_written"), F.when(gone, at).alias("_deleted"),
                     *[cell(c) for c in columns])


def fold(changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per key: the latest version of everything. A single aggregate with partial results per task."""
    return changes.groupBy(key).agg(
        F.max("_written").alias("_written"), F.max("_deleted").alias("_deleted"),
        *[F.max_by(c, F.col(f"{c}.version")).alias(c) for c in columns],
    )


def living(folded: DataFrame, columns: list[str]) -> DataFrame:
    """Folded rows that were written after their last removal, with the values set after it, and no trace of the removal."""
    def cell(name: str) -> Column:
        alive = F.col("_deleted").isNull() | (F.col(f"{name}.version") > F.col("_deleted"))
        return F.when(alive, F.col(name)).alias(name)

    kept = folded.filter("_written is not null and (_deleted is null or _written > _deleted)")
    return kept.withColumns({c: cell(c) for c in columns}).withColumn("_deleted", F.lit(None).cast(folded.schema["_deleted"].dataType))


def current(changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The table as it is now."""
    return living(fold(changes, key, columns), columns).select(key, *[F.col(f"{c}.value").alias(c) for c in columns])


@dataclass(frozen=True)
class KeyedTable:
    """Slices below ``path``, split by a hash bucket of the key so that a lookup reads one bucket.

    The manifest holds the number of buckets, the epoch that the base reaches, and the folder of each epoch. Opening the
    table with another number of buckets would look for keys in the wrong ones, so every later use is refused then;
    :meth:`opened` reads the stored number. :meth:`replace` and :meth:`compact` move all readers that open the table after
    them; frames opened before keep the rows of their version, whose folders stay.
    """

    spark: SparkSession
    path: str
    key: str
    key_type: str
    columns: dict[str, str] = field(default_factory=dict)
    buckets: int = 16

    @property
    def schema(self) -> T.StructType:
        cells = [f"{c} struct<version: struct<epoch: bigint, step: bigint>, value: {t}>"
                 for c, t in self.columns.items()]
        mark = "struct<epoch: bigint, step: bigint>"
        return T.StructType.fromDDL(", ".join(
            [f"{self.key} {self.key_type}", f"_written {mark}", f"_deleted {mark}", *cells, f"{SLICE} string", f"{BUCKET} int"]))

    @property
    def manifest(self) -> Manifest:
        return Manifest(self.spark, self.path)

    def bucket(self, key: Column) -> Column:
        return bucket_of(key.cast(self.key_type), self.buckets)

    def state(self) -> dict:
        """The last version of the table: buckets, base, and slices by epoch."""
        return self._checked(self.manifest.latest()[1])

    def _checked(self, state: dict | None) -> dict:
        state = state or {"buckets": self.buckets, "base": None, "slices": {}}
        if state["buckets"] != self.buckets:
            raise ValueError(f"{self.path} has {state['buckets']} buckets, not {self.buckets}")
        return state

    def opened(self) -> KeyedTable:
        """The same table with its stored number of buckets."""
        state = self.manifest.latest()[1]
        return replace(self, buckets=state["buckets"]) if state else self

    def _put(self, folded: DataFrame) -> str:
        name = uuid.uuid4().hex
        put_buckets(folded, f"{self.path}/{SLICE}={name}", self.key, self.buckets)
        return name

    def _changes(self, df: DataFrame, epoch: int, step: str | None, deleted: Column | None = None) -> DataFrame:
        changes = as_changes(df, self.key, list(self.columns), version(epoch, step if step else 0), deleted)
        return fold(changes, self.key, list(self.columns))

    def write(self, df: DataFrame, epoch: int, step: str | None = None, deleted: Column | None = None) -> None:
        """Upsert (or remove) rows as epoch ``epoch``. ``step`` orders changes of one key inside it. An epoch that the base
        already holds is left as it is."""
        base = self.state()["base"]
        if base is not None and epoch <= base:
            return
        name = self._put(self._changes(df, epoch, step, deleted))

        def named(state: dict | None) -> dict:
            state = self._checked(state)
            if state["base"] is not None and epoch <= state["base"]:
                return state
            return {**state, "slices": {**state["slices"], str(epoch): name}}

        self.manifest.change(named)

    def slices(self, up_to: int | None = None) -> DataFrame:
        """Stored changes, restricted to epochs ``<= up_to`` if given (a repeated epoch must not see itself
        or later ones)."""
        names = [n for e, n in self.state()["slices"].items() if up_to is None or int(e) <= up_to]
        if not names:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(
            *[f"{self.path}/{SLICE}={n}" for n in names])

    def read(self, up_to: int | None = None) -> DataFrame:
        return current(self.slices(up_to), self.key, list(self.columns))

    def lookup(self, *keys) -> DataFrame:
        """Rows of some keys: only their buckets are read, and the key filter reaches the scan.

        Literals get the key's own type; a literal of another type would turn into a cast of the column.
        """
        typed = [F.lit(k).cast(self.key_type) for k in keys]
        stored = self.slices()
        wanted = stored.filter(F.col(BUCKET).isin(*[self.bucket(k) for k in typed])
                               & F.col(self.key).isin(*typed))
        return current(wanted, self.key, list(self.columns))

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """Rows of the keys in a frame: their buckets are read, and met with the keys in a semi-join."""
        wanted = near_keys(self.slices(), keys.select(F.col(self.key).cast(self.key_type)), self.key, self.buckets)
        return current(wanted.join(keys.select(self.key).distinct(), self.key, "left_semi"),
                       self.key, list(self.columns))

    def replace(self, df: DataFrame, epoch: int, step: str | None = None) -> KeyedTable:
        """The whole table replaced: from the next version on it holds ``df`` only, as epoch ``epoch``."""
        name = self._put(living(self._changes(df, epoch, step), list(self.columns)))
        self.manifest.change(lambda state: {**self._checked(state), "base": epoch, "slices": {str(epoch): name}})
        return self

    def compact(self, up_to: int) -> KeyedTable:
        """Fold epochs up to ``up_to`` into one base slice. There is nothing before the base, so removed rows leave no
        trace in it. Later epochs, also those written meanwhile, stay as they are."""
        before = self.state()
        if before["base"] is not None and up_to < before["base"]:
            return self
        columns = list(self.columns)
        name = self._put(living(fold(self.slices(up_to).drop(SLICE, BUCKET), self.key, columns), columns))

        def swapped(state: dict | None) -> dict:
            state = self._checked(state)
            if state["base"] != before["base"]:  # replaced or compacted meanwhile
                return state
            later = {e: n for e, n in state["slices"].items() if int(e) > up_to}
            return {**state, "base": up_to, "slices": {str(up_to): name, **later}}

        self.manifest.change(swapped)
        return self
