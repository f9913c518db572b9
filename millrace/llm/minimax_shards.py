"""Sharding by a minimax contiguous partition of groups of equal texts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize, numbered, text_column, with_lanes

STEP = 12  # bits of the key that one level of cells adds
KEY_BITS = 64


@dataclass(frozen=True)
class Cell:
    """All groups whose keys share leading bits; ``whole`` if that is a single group."""
    low: int
    depth: int
    prefix: int
    size: int
    whole: bool


def sized(docs: DataFrame) -> DataFrame:
    """Size and group key of each row. Equal texts have equal keys; null counts as the empty text."""
    text = text_column()
    return docs.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"))


def _prefix(depth: int):
    return F.shiftright("key", KEY_BITS - depth) if depth < KEY_BITS else F.col("key")


def read_cells(rows: DataFrame, depth: int, parents: list[int] | None = None, above: int = 0) -> list[Cell]:
    """Cells of a depth, of all rows or of those below some parent cells: at most 2**STEP for each parent."""
    if parents is not None:
        rows = rows.where(_prefix(above).isin(parents))
    found = rows.groupBy(_prefix(depth).alias("prefix")).agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.sum("size").alias("size")).collect()
    return [Cell(r["low"], depth, r["prefix"], r["size"], r["low"] == r["high"]) for r in found]


def greedy(ends: np.ndarray, whole: np.ndarray, capacity: int, shards: int) -> list[tuple[int, bool]] | None:
    """Cut positions of shards filled one after another, or None if the capacity is too small.

    A cell that is not known to be one group may be cut anywhere, so the answer is optimistic until every
    cell that is cut is whole. Each cut says whether it lies on the end of a cell.
    """
    cuts, start, total = [], 0, int(ends[-1])
    for _ in range(shards):
        end = start + capacity
        if end >= total:
            return cuts
        at = int(np.searchsorted(ends, end, "right"))  # the cell that holds the position
        before = int(ends[at - 1]) if at else 0
        stop = before if whole[at] else end
        if stop <= start:
            return None
        cuts.append((stop, stop == before))
        start = stop
    return None


def least_capacity(ends: np.ndarray, whole: np.ndarray, shards: int) -> int:
    low, high = -(-int(ends[-1]) // shards), int(ends[-1])
    while low < high:
        middle = (low + high) // 2
        if greedy(ends, whole, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low


def cut_keys(cells: list[Cell], shards: int, read: Callable[[int, list[int], int], list[Cell]]) -> list[int]:
    """Keys at which new shards begin, for the least feasible capacity.

    Cells between the cuts of the optimistic capacity and those of one that never cuts a cell are read
    again in finer bits until the optimistic cuts all lie between groups; its capacity, a lower bound, is
    then reached.
    """
    while True:
        cells = sorted(cells, key=lambda c: c.low)
        if not cells:
            return []
        sizes = np.array([c.size for c in cells], np.int64)
        ends, whole = np.cumsum(sizes), np.array([c.whole for c in cells])
        capacity = least_capacity(ends, whole, shards)
        cuts = greedy(ends, whole, capacity, shards)
        if all(exact for _, exact in cuts):
            return [cells[int(np.searchsorted(ends, cut, "right"))].low for cut, _ in cuts]
        solid = np.ones(len(cells), bool)
        others = greedy(ends, solid, least_capacity(ends, solid, shards), shards)
        unsure: set[int] = set()
        for j, (cut, _) in enumerate(cuts):
            reach = [cut, others[min(j, len(others) - 1)][0] if others else cut]
            first, last = (int(np.searchsorted(ends, x, "right")) for x in (min(reach), max(reach)))
            unsure.update(i for i in range(first, min(last, len(cells) - 1) + 1) if not whole[i])
        finer = [c for i, c in enumerate(cells) if i not in unsure]
        for depth in sorted({cells[i].depth for i in unsure}):
            parents = [cells[i].prefix for i in unsure if cells[i].depth == depth]
            finer += read(min(depth + STEP, KEY_BITS), parents, depth)
        cells = finer


def shard_by_bytes(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Deal documents to shards of near equal bytes, groups of equal texts staying together.

    Groups are ordered by a hash of their text, and the order is cut where the largest shard is as small as
    any such cut allows. A group above its fair share (there are fewer than ``shards`` of them) would leave
    the shards beside it short, so it gets a shard of its own first; the others are cut for what remains.

    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32, law ('bytes'), shard, slot (gapless from 0 in
    each shard), grown_shard (null: the law is not 'key'). Null and empty texts have size 1 and share a
    group; repeated rows all stay; other columns are ignored; an empty table gives an empty one.

    Size summaries of at most 2**STEP cells a parent reach the driver, never keys or rows.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    rows = materialize(with_lanes(sized(docs)), "sized")
    whole = rows.agg(F.count("*").alias("n"), F.sum("size").alias("size")).first()
    left, free, heavy = whole["size"] or 0, shards, []
    if whole["n"] and shards > 1:
        large = rows.groupBy("key").agg(F.sum("size").alias("size")).where(
            F.col("size") * shards > whole["size"]).orderBy(F.desc("size"), "key").collect()
        # A peeled group lowers the fair share of the rest, but not below their own need: go on while it is exceeded.
        for r in large:
            if free > 1 and r["size"] * free > left:
                heavy.append(r["key"])
                left, free = left - r["size"], free - 1
    rest = rows.where(~F.col("key").isin(heavy)) if heavy else rows
    cuts = cut_keys(read_cells(rest, STEP), free, lambda depth, parents, above: read_cells(rest, depth, parents, above))
    shard = sum((F.when(F.col("key") >= cut, 1).otherwise(0) for cut in cuts), F.lit(len(heavy)))
    for i, key in enumerate(heavy):
        shard = F.when(F.col("key") == key, F.lit(i)).otherwise(shard)
    rows = rows.withColumn("shard", shard.cast("int"))
    counts = dict(rows.groupBy("shard").count().collect())
    dealt = numbered(rows, [counts.get(i, 0) for i in range(shards)], "shard", ["doc_id", "key"], "slot")
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))
