"""Embedding near-duplicates through a pivot-permutation index.

A vector is described by its nearest reference points (pivots) in order. Vectors that are close share most
of them, so a pair is a candidate if at least two of their nearest pivots agree. The inverted lists are kept
by pairs of pivots: two vectors meet under every pair of pivots that both name, and the pair of the two
lowest shared pivots alone checks them, so each candidate is verified and counted once.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import spanning_links, whole_cells
from millrace.llm.common import materialize
from millrace.llm.components import components

LEAST = 0.95
PIVOTS = 256        # reference points at least; they grow with the root of the number of vectors
SAMPLE = 16         # vectors that they are chosen from, for each of them
APART = 0.8         # largest cosine between two of them
PREFIX = 6          # nearest pivots that describe a vector, with the fewest pivots
BLOCK = 1024        # vectors compared with as many others at a time
SMALL = 4 * BLOCK   # vectors of a length that need no pivots: all are compared


def pivots_for(vectors: int) -> tuple[int, int]:
    """Number of pivots, a power of two of at least the root of the number of vectors, so that lists stay as long as they
    are; and how many nearest ones describe a vector: one more whenever the pivots are four times as many."""
    pivots = PIVOTS
    while pivots * pivots < vectors:
        pivots *= 2
    return pivots, PREFIX + (pivots // PIVOTS).bit_length() // 2


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding and a hash of it for every row; the embedding is null where it links with nothing: empty, zero, with
    null or non-finite components."""
    plain = F.transform("embedding", lambda x: x + F.lit(0.0).cast("float"))  # one zero, not two
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.col("embedding").isNotNull() & ~odd & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long"), F.when(fine, plain).alias("embedding"))
    return rows.withColumn("print", F.xxhash64("embedding"))


def classes_of(rows: DataFrame) -> DataFrame:
    """Each different vector once: node (any number), embedding, its hash and length, how many (vec_id, vector) have it, and
    the least of their ids."""
    keys = rows.where("embedding is not null").distinct()
    same = keys.groupBy("print", "embedding").agg(F.count("*").alias("m"), F.min("vec_id").alias("least_id"))
    return materialize(same.select(F.monotonically_increasing_id().alias("node"), "print", "embedding",
                                   F.size("embedding").alias("length"), "m", "least_id"), "vectors")


def unit(columns: np.ndarray) -> np.ndarray:
    scaled = columns / np.abs(columns).max(1, keepdims=True)
    return scaled / np.sqrt(np.square(scaled).sum(1, keepdims=True))


def choose_pivots(classes: DataFrame, most: int, apart: float = APART) -> np.ndarray:
    """Pivots from the first vectors by hash, SAMPLE for each: one is kept unless it is close to one kept before, so that a
    large group of near copies gives one pivot and not most of them."""
    drawn = classes.orderBy("print", "node").limit(SAMPLE * most).select("embedding").toArrow()["embedding"]
    vectors = unit(as_matrix(drawn))
    chosen = np.zeros((0, vectors.shape[1]))
    for first in range(0, len(vectors), BLOCK):
        some = vectors[first:first + BLOCK]
        near = some @ some.T
        free = (some @ chosen.T).max(1, initial=-1.0) < apart
        kept: list[int] = []
        for i in np.flatnonzero(free).tolist():
            if len(chosen) + len(kept) < most and (not kept or near[i, kept].max() < apart):
                kept.append(i)
        chosen = np.concatenate([chosen, some[kept]])
        if len(chosen) == most:
            break
    return chosen


def as_matrix(column) -> np.ndarray:
    """Equally long lists as rows of doubles."""
    flat = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def listed(classes: DataFrame, pivots: dict[int, tuple[np.ndarray, int]]) -> DataFrame:
    """A row (length, key, node, m, nearest, vector) for each pair of the nearest pivots of each vector; one with key -1 for a
    length without pivots."""
    def run(batches):
        for batch in batches:
            lengths = batch.column(0).to_numpy()
            for length in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == length))
                vectors = unit(as_matrix(part.column(3)))
                if length in pivots:
                    points, prefix = pivots[length]
                    prefix = min(prefix, len(points))
                    pairs = np.array(list(combinations(range(prefix), 2)) or [(0, 0)])
                    nearest = np.sort(np.argsort(-(vectors @ points.T), 1, kind="stable")[:, :prefix], 1)
                    keys = nearest[:, pairs[:, 0]] * len(points) + nearest[:, pairs[:, 1]]
                else:
                    nearest, keys = np.zeros((len(vectors), 1), np.int64), np.full((len(vectors), 1), -1)
                for k in range(keys.shape[1]):
                    yield pa.RecordBatch.from_arrays([
                        part.column(0), pa.array(keys[:, k]), part.column(1), part.column(2),
                        pa.FixedSizeListArray.from_arrays(nearest.astype(np.int32).ravel(), nearest.shape[1]).cast(pa.list_(pa.int32())),
                        pa.FixedSizeListArray.from_arrays(vectors.ravel(), length).cast(pa.list_(pa.float64()))],
                        ["length", "key", "node", "m", "nearest", "vector"])

    return classes.select("length", "node", "m", "embedding").mapInArrow(
        run, "length int, key long, node long, m long, nearest array<int>, vector array<double>")


def cell_links(key: int, nodes: np.ndarray, many: np.ndarray, nearest: np.ndarray, vectors: np.ndarray, side: np.ndarray,
               pivots: int, least: float) -> np.ndarray:
    """(node, label, n): for each vector of a cell that links, the least node it is joined to, and the rows it links with.

    ``side`` is 0 or 1 for the two blocks of a cell, or 2 throughout if the cell is one block with itself. A pair belongs to
    the key if the key's pivots are the lowest two that they share; a key of -1 has all pairs.
    """
    own = side[0] == 2
    a = np.ones(len(nodes), bool) if own else side == 0
    b = a if own else side == 1
    if not a.any() or not b.any():
        return np.zeros((3, 0), np.int64)
    linked = (vectors[a] @ vectors[b].T) >= least
    if own:
        np.fill_diagonal(linked, False)
    if key >= 0 and linked.any():
        first, second = divmod(key, pivots)
        lower = np.where(nearest < second, nearest, -1)
        names, place = np.unique(lower, return_inverse=True)
        below = np.zeros((len(nodes), len(names)), np.float32)
        np.put_along_axis(below, place.reshape(lower.shape), 1, 1)
        below[:, names < 0] = 0
        # With a single pivot all vectors share the one key.
        linked &= (below[a] @ below[b].T == 1) | (first == second)
    counts = np.concatenate([linked @ many[b]] if own else [linked @ many[b], linked.T @ many[a]])
    order = nodes[a] if own else np.concatenate([nodes[a], nodes[b]])
    label = dict(zip(*(x.tolist() for x in spanning_links(linked, nodes[a], nodes[b]))))
    some = counts > 0
    found = order[some]
    return np.stack([found, np.array([label.get(i, i) for i in found.tolist()], np.int64).reshape(-1), counts[some]])


def verified(entries: DataFrame, pivots: dict[int, int], least: float, block: int = BLOCK) -> DataFrame:
    """(node, label, n) of every cell. Lists longer than a block are cut into blocks by a hash and every pair
    of blocks is a cell, so tasks stay small; a cell emits one row per linked vector, not per pair."""
    name = ["length", "key"]
    long = materialize(entries.groupBy(*name).agg(F.count("*").alias("n")).where(F.col("n") > block).select(
        *name, F.ceil(F.col("n") / block).cast("int").alias("blocks")), "long")
    rows = entries.join(long, name, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    cells = rows.select(*name, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                        side.cast("int").alias("side"), "node", "m", "nearest", "vector")

    def run(batches):
        for cell in whole_cells(batches, 4):
            if cell.num_rows > 1:
                side, nodes, many = (cell[c].to_numpy() for c in ("side", "node", "m"))
                found = cell_links(cell["key"][0].as_py(), nodes, many, as_matrix(cell["nearest"]).astype(np.int64),
                                   as_matrix(cell["vector"]), side, pivots.get(cell["length"][0].as_py(), 1), least)
                if found.size:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["node", "label", "n"])

    at = [*name, "i", "j"]
    return cells.repartition(*at).sortWithinPartitions(*at).mapInArrow(run, "node long, label long, n long")


def near_duplicates(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """Link vectors whose cosine is at least ``least``, compared in double precision, whatever their other columns.

    Returns each row's vec_id, n_links (other vectors linked directly), component_id (least vec_id reachable, itself
    included) and kept (vec_id = component_id). A vector is a pair of vec_id and components: rows that repeat both are one
    and count once, rows of an id with other components are others, also those of a null id. Null ids are never the least
    of others and are not kept; a component without any other id has none. Null, empty or zero vectors and vectors with
    null or non-finite components link with nothing. Vectors link with those of their own length, whatever it is. An
    empty table gives an empty one.

    Equal vectors are searched once. Pivots are fitted for each length on a bounded draw and grow with the number of its
    vectors; every vector is indexed. A pair is missed only if its vectors share less than two of their nearest pivots; no
    list is capped. A length of at most SMALL different vectors is compared whole.
    """
    rows = usable(vectors)
    classes = classes_of(rows)
    large = classes.groupBy("length").count().where(F.col("count") > SMALL).collect()
    pivots = {}
    for r in large:
        many, prefix = pivots_for(r["count"])
        pivots[r["length"]] = choose_pivots(classes.where(F.col("length") == r["length"]), many), prefix
    found = materialize(verified(listed(classes, pivots), {d: len(p) for d, (p, _) in pivots.items()}, least), "verified")
    groups = components(found.select(F.col("node").alias("u"), F.col("label").alias("v")))
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    known = classes.join(counts, "node", "left").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = known.groupBy("component").agg(F.min("least_id").alias("component_id"))
    per_class = known.join(names, "component").select(
        "print", "embedding", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), "component_id", F.lit(True).alias("_found"))
    joined = rows.join(per_class, ["print", "embedding"], "left")
    # What links with nothing is its own component.
    component = F.when(F.col("_found"), F.col("component_id")).otherwise(F.col("vec_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
