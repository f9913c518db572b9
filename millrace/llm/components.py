"""Connected components by alternating stars, as joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize

FEW = 200_000  # links whose round is read and folded in one task: more tasks and shuffles are a burden to the driver only


def both_ways(edges: DataFrame) -> DataFrame:
    ends = F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))))
    return edges.select(ends.alias("e")).select("e.u", "e.v")


def large_star(edges: DataFrame, few: bool = False) -> DataFrame:
    """Link each node's larger neighbours to the least node of its neighbourhood."""
    ends = both_ways(edges)
    least = ends.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = ends.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (moved.coalesce(1) if few else moved).distinct()


def small_star(edges: DataFrame, few: bool = False) -> DataFrame:
    """Link each node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    # A neighbour that is not the least is linked to the least, and so is the node itself, by the row of its least neighbour.
    moved = down.join(least, "u").select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
    return (moved.coalesce(1) if few else moved).distinct()


def fingerprint_of(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 2147483647).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v), component being its least node.

    Rounds of a large and a small star end in one star per component; their number grows with the
    logarithm of the longest chain. Each round is written, so a lost executor costs one round; rounds of up to FEW links
    have few tasks. Self-links
    and repeated links are harmless, an empty table gives an empty one. A star's centre is a hot key only
    of joins, which adaptive execution splits, and of minima, which combine before the shuffle.
    """
    edges = materialize(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    seen = fingerprint_of(edges)
    for _ in range(most_rounds):
        if not seen[0]:
            break
        few = seen[0] <= FEW
        edges = materialize(small_star(large_star(edges.coalesce(1) if few else edges, few), few), "stars")
        now = fingerprint_of(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    centres = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres)
