"""SimHash near-duplicates, with candidates pruned by the pigeonring principle.

Cut the 64 bits of two fingerprints into m segments on a ring. If they differ in at most t bits, some start
exists from which every chain of l consecutive segments differs in at most l * t / m bits. With m = t + 1
the first segment of that chain is equal and the second differs in at most one bit, so a key of two
segments finds every pair: one side offers its two segments, the other also its second segment with one
bit set. Longer chains are then checked against their budgets before the full distance.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import Joined, spanning_links, whole_cells
from millrace.llm.common import map_texts, materialize, set_apart, split_text, strings, text_rows
from millrace.llm.components import components

BITS = 64
SEED = 42
CHUNK = 100_000  # shingles whose bits are counted at a time
HEAVY = 16  # fingerprints under one key beyond which pairs are found in blocks, and joined by as few links as rows
BLOCK = 1024
KEYS = 500_000  # of a task that lists them
HELD = 500_000  # nodes whose links a task remembers


def shingle_hashes(text: str, words: int) -> list[int]:
    """XXH64 of every shingle: ASCII lower case, ASCII white space, joined by one space."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if len(parts) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(parts), SEED)] if parts else []
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts[:len(parts) - words + 1].tolist(), ends[words - 1:].tolist())]


def fold(hashes: list[int], counts: list[int]) -> np.ndarray:
    """Fingerprints of consecutive runs of hashes: a bit is set if over half of the run sets it."""
    sums = np.zeros((len(counts), BITS), np.int64)
    flat = np.array(hashes, np.uint64)
    owner = np.repeat(np.arange(len(counts)), counts)
    for first in range(0, len(flat), CHUNK):
        part = flat[first:first + CHUNK].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[first:first + CHUNK]
        heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        sums[own[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    ones = sums * 2 > np.array(counts, np.int64)[:, None]
    return np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, words: int = 4, keep: list[str] | None = None) -> DataFrame:
    """The columns of ``keep`` (doc_id by default) and print, the 64-bit SimHash of the text as a signed long.
    Texts without words have 0."""
    def run(batches):
        for batch in batches:
            text, columns, kept = split_text(batch)
            texts = strings(text)
            out, hashes, counts = [], [], []
            for text in texts:
                own = shingle_hashes(text, words)
                hashes += own
                counts.append(len(own))
                if len(hashes) >= CHUNK:
                    out.append(fold(hashes, counts))
                    hashes, counts = [], []
            if counts:
                out.append(fold(hashes, counts))
            prints = np.concatenate(out) if out else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(prints.view(np.int64))], [*kept, "print"])

    rows, schema = text_rows(docs, ["doc_id"] if keep is None else keep)
    return map_texts(rows, run, f"{schema}, print long")


def segments(distance: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of distance + 1 segments of near equal width."""
    m = distance + 1
    edges = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def part(value: Column, segment: tuple[int, int]) -> Column:
    low, width = segment
    return F.shiftrightunsigned(value, low).bitwiseAND((1 << width) - 1)


def chain_key(value: Column, ring: list[tuple[int, int]], i: int) -> Column:
    """Start, first and second segment in one number."""
    first, second = ring[i], ring[(i + 1) % len(ring)]
    return F.shiftleft(F.shiftleft(F.lit(i).cast("long"), first[1]).bitwiseOR(part(value, first)), second[1]).bitwiseOR(
        part(value, second))


def offered(prints: DataFrame, ring: list[tuple[int, int]]) -> DataFrame:
    keys = F.array(*[chain_key(F.col("print"), ring, i) for i in range(len(ring))])
    return prints.select("rep", "print", F.explode(keys).alias("key"))


def asked(prints: DataFrame, ring: list[tuple[int, int]]) -> DataFrame:
    """The keys themselves, and those with one more bit in the second segment: of two keys that differ in
    one bit there, one side lacks it."""
    keys = []
    for i in range(len(ring)):
        key, width = chain_key(F.col("print"), ring, i), ring[(i + 1) % len(ring)][1]
        keys.append(key)
        keys += [F.when(key.bitwiseAND(1 << b) == 0, key.bitwiseOR(1 << b)) for b in range(width)]
    return prints.select("rep", "print", F.explode(F.array(*keys)).alias("key")).where("key is not null")


def within_budgets(ring: list[tuple[int, int]], distance: int) -> Column:
    """Every chain from the key's start keeps its budget; the last chain is the whole ring."""
    difference = F.col("a_print").bitwiseXOR(F.col("b_print"))
    second_width = [ring[(i + 1) % len(ring)][1] for i in range(len(ring))]
    checks = []
    for i in range(len(ring)):
        start = F.shiftrightunsigned("key", ring[i][1] + second_width[i]) == i
        mask, tests = 0, []
        for l in range(1, len(ring) + 1):
            low, width = ring[(i + l - 1) % len(ring)]
            mask |= ((1 << width) - 1) << low
            signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
            if l > 2:
                tests.append(F.bit_count(difference.bitwiseAND(F.lit(signed).cast("long"))) <= l * distance // len(ring))
        checks.append(start & reduce(Column.__and__, tests) if tests else start)
    # The whole distance holds for chains of one or two segments as well.
    return reduce(Column.__or__, checks) & (F.bit_count(difference) <= distance)


def chain_masks(ring: list[tuple[int, int]], distance: int, i: int) -> list[tuple[int, int]]:
    """(mask, budget) of the chains of three and more segments from segment i; the last one is the whole ring."""
    masks, mask = [], 0
    for l in range(1, len(ring) + 1):
        low, width = ring[(i + l - 1) % len(ring)]
        mask |= ((1 << width) - 1) << low
        if l > 2 or l == len(ring):
            masks.append((mask, l * distance // len(ring) if l < len(ring) else distance))
    return masks


def block_links(rows: pd.DataFrame, distance: int) -> pd.DataFrame:
    """Links between the offering and the asking rows of one cell: chain after chain of segments from the key's start must
    keep its budget, and only pairs that do are looked at further."""
    ring, key = segments(distance), int(rows["key"].iloc[0])
    # Segments differ in width, so a key may be one of two starts.
    starts = [i for i in range(len(ring)) if key >> (ring[i][1] + ring[(i + 1) % len(ring)][1]) == i]
    asks = rows["asks"].to_numpy()
    a, b = rows[asks], rows[~asks]
    x, y = a["print"].to_numpy(np.int64).view(np.uint64), b["print"].to_numpy(np.int64).view(np.uint64)
    found = []
    for first in range(0, len(x), BLOCK):
        part = x[first:first + BLOCK]
        near = np.zeros((len(part), len(y)), bool)
        for start in starts:
            (mask, budget), *longer = chain_masks(ring, distance, start)
            i, j = np.nonzero(np.bitwise_count((part[:, None] ^ y[None, :]) & np.uint64(mask)) <= budget)
            for mask, budget in longer:
                within = np.bitwise_count((part[i] ^ y[j]) & np.uint64(mask)) <= budget
                i, j = i[within], j[within]
            near[i, j] = True
        found.append(spanning_links(near, a["rep"].to_numpy(np.int64)[first:first + BLOCK], b["rep"].to_numpy(np.int64)))
    u, v = (np.concatenate(z) for z in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    return pd.DataFrame({"u": u, "v": v})


def heavy_links(offers: DataFrame, asks: DataFrame, heavy: DataFrame, distance: int) -> DataFrame:
    """Pairs under keys with many fingerprints, compared in cells of about BLOCK by BLOCK rows.

    Each side is dealt to blocks by a hash and repeated for the blocks of the other side, so a key of any
    size is spread over tasks; a task emits the links that join what its cells before have not joined, less than one
    per fingerprint however many cells or pairs it has.
    """
    sizes = heavy.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))

    def dealt(side: DataFrame, own: str, other: str, is_ask: bool) -> DataFrame:
        own_block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias(other)
        return side.join(sizes, "key").select("key", "rep", "print", F.lit(is_ask).alias("asks"), own_block, every)

    rows = dealt(offers, "i", "j", False).unionByName(dealt(asks, "j", "i", True))

    def run(batches):
        joined = Joined(HELD)
        for cell in whole_cells(batches, 3):
            found = block_links(cell.to_pandas(), distance)
            yield pa.RecordBatch.from_pandas(found[joined.new(found["u"].tolist(), found["v"].tolist())], preserve_index=False)

    cells = rows.select("key", "i", "j", "rep", "print", "asks").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return cells.mapInArrow(run, "u long, v long")


def links(prints: DataFrame, distance: int) -> DataFrame:
    """Links (u, v) between the representatives of fingerprints, enough to join what any pair within the
    distance joins. ``prints`` holds each fingerprint once, as (rep, print)."""
    ring = segments(distance)
    # The few bytes of a print become a row for each of its keys: as many tasks as those rows need.
    per_print = sum(2 + width for _, width in ring)
    prints = prints.repartition(max(1, -(-prints.count() * per_print // KEYS)), "print")
    offers, asks = offered(prints, ring), asked(prints, ring)
    heavy = materialize(offers.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HEAVY), "heavy")
    light = asks.select("key", F.col("rep").alias("u"), F.col("print").alias("a_print")).join(
        offers.join(heavy.select("key"), "key", "left_anti").select(
            "key", F.col("rep").alias("v"), F.col("print").alias("b_print")), "key")
    light = light.where(F.col("u") != F.col("v")).where(within_budgets(ring, distance)).select("u", "v")
    return light.unionByName(heavy_links(offers, asks, heavy, distance))


def grouped(docs: DataFrame, words: int, distance: int, keep: list[str], order: Column) -> tuple[DataFrame, DataFrame]:
    """The columns of ``keep`` and print of every row; and for each print its group (the least print of those
    linked) and the least ``order`` of the group's rows."""
    if not 0 <= distance < BITS // 2:
        raise ValueError("distance must be from 0 to 31")
    clash = {"print", "component_id", "component", "node", "rep", "text_to_read"} & set(keep)
    if clash:
        raise ValueError(f"columns named like results: {sorted(clash)}")
    prints = materialize(fingerprints(docs, words, keep), "prints")
    classes = materialize(prints.groupBy("print").agg(F.min(order).alias("least")), "classes")
    if not distance:
        return prints, classes.select("print", F.col("print").alias("component"), "least")
    # Prints name the classes: ids may be null or stand at several texts.
    groups = components(links(classes.select(F.col("print").alias("rep"), "print"), distance))
    members = groups.join(classes, groups["node"] == classes["print"])
    lead = members.groupBy("component").agg(F.min("least").alias("lead"))
    linked = groups.join(lead, "component").select("node", "component", "lead")
    return prints, classes.join(linked, classes["print"] == linked["node"], "left").select(
        "print", F.coalesce("component", "print").alias("component"), F.when(F.col("node").isNull(), F.col("least")).otherwise(F.col("lead")).alias("least"))


def near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """Group documents whose SimHash fingerprints are linked by steps of at most ``distance`` bits.

    Returns doc_id, fingerprint (16 hex digits), component_id (least doc_id of the group). A null or empty
    text, or one without words, has fingerprint zero and is linked like any other; repeated rows each keep
    their row; null ids keep theirs, too, and never name a group unless all its ids are null; rows that share an
    id are linked by their texts alone; other columns are ignored; an empty table gives an empty one.

    Copies are folded to one fingerprint before any comparison, and links become rows only between
    fingerprints. Every pair within the distance is found; no bucket is capped.
    """
    rows, groups = grouped(docs, words, distance, ["doc_id"], F.col("doc_id").cast("long"))
    return rows.join(groups, "print").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), F.col("least").alias("component_id"))


def one_of_each(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """One row of each group, all columns kept: the one with the least doc_id, nulls last, and of several texts with
    that id the one whose text has the least hash. Of repeated rows one stays."""
    plain = set_apart(docs, "doc_id", "text")
    doc = F.col("doc_id").cast("long")
    order = F.struct(doc.isNull(), doc, F.xxhash64("text"))
    rows, groups = grouped(plain, words, distance, plain.columns, order)
    lead = rows.join(groups, "print").where(order.eqNullSafe(F.col("least")))
    return lead.dropDuplicates(["component"]).select(*plain.columns).toDF(*docs.columns)
