"""Best-fit packing of tokenised documents by fitted length patterns.

The histogram of piece lengths has at most ``capacity`` entries whatever the corpus, so the plan is made on
the driver: patterns of up to three lengths that fill a sequence are enumerated, their repeat counts are
fitted to the histogram by non-negative least squares and rounded, and what remains is packed best-fit,
longest first, by counts. Tasks then look up each piece's place from its number among pieces of its length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import byte_tokens
from millrace.llm.common import map_texts, materialize, numbered, strings, with_lanes

CAPACITY = 1024
END_ID = 2
STEPS = 1000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of every document: its ids and the end id, cut only if longer than ``capacity``; then the
    first piece takes the odd length and the others are full."""
    def run(batches):
        encode = byte_tokens.encoder(path or byte_tokens.vocabulary_path())
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), strings(batch.column(1))):
                ids = np.array([*encode(text), END_ID], "<u4")
                first = len(ids) % capacity or capacity
                for i, start in enumerate([0, *range(first, len(ids), capacity)]):
                    part = ids[start:first if not i else start + capacity]
                    rows.append((doc, i, start, len(part), zlib.crc32(part.tobytes())))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_texts(docs.select(F.col("doc_id").cast("long"), "text"), run, PIECES)


def filling_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """All rows of up to three of the lengths, longest first, that sum to the capacity; 0 stands for none."""
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    there[0] = True
    first, second = np.meshgrid(np.arange(1, capacity + 1), np.arange(capacity + 1), indexing="ij")
    third = capacity - first - second
    good = (first >= second) & (second >= third) & (third >= 0)
    rows = np.stack([first[good], second[good], third[good]], 1)
    return rows[there[rows].all(1)]


def fit_repeats(patterns: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeats x >= 0 that bring A x near the counts, A counting each length in each pattern; short lengths
    weigh less, for they fill gaps anyway. Accelerated projected gradient steps."""
    n = len(counts)
    weight = np.sqrt(np.arange(n) / (n - 1))
    weight[0] = 0

    def times(x):  # A x
        return sum(np.bincount(patterns[:, k], x, n) for k in range(3)) * weight

    def back(r):  # A' r
        r = r * weight
        return sum(r[patterns[:, k]] for k in range(3))

    v = np.ones(len(patterns))
    for _ in range(20):
        w = back(times(v))
        norm = np.linalg.norm(w)
        v = w / norm if norm else v
    step = 1 / (norm * 1.05 or 1)
    goal = counts * weight
    x = ahead = np.zeros(len(patterns))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(ahead - step * back(times(ahead) - goal), 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts by length: (pattern, repeats)."""
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)  # by free room
    for length in range(capacity, 0, -1):
        count = int(left[length])
        for room in range(length, capacity):
            if not count:
                break
            # Bins with the least room that holds the length; a bin takes as many as fit.
            waiting, open_bins[room] = open_bins[room], []
            for pattern, n in waiting:
                while n and count:
                    each = min(room // length, count)
                    m = min(n, count // each)
                    open_bins[room - each * length].append((pattern + (length,) * each, m))
                    n, count = n - m, count - m * each
                if n:
                    open_bins[room].append((pattern, n))
        each = capacity // length
        if count // each:
            open_bins[capacity - each * length].append(((length,) * each, count // each))
        if count % each:
            open_bins[capacity - count % each * length].append(((length,) * (count % each), 1))
    return [x for bins in open_bins.values() for x in bins]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) that place every counted piece exactly once. ``counts`` is indexed by length.

    If best fit alone needs fewer sequences, as it may on few pieces, its plan is taken.
    """
    left = counts.astype(np.int64).copy()
    full = int(left[capacity])
    left[capacity] = 0
    alone = best_fit(left, capacity)
    patterns = filling_patterns(np.flatnonzero(left), capacity)
    chosen: dict[tuple[int, ...], int] = defaultdict(int)
    if len(patterns):
        repeats = np.floor(fit_repeats(patterns, left.astype(float))).astype(np.int64)
        # Rounded down; the most frequent patterns come first where the fit overshoots a length.
        for i in np.argsort(-repeats, kind="stable")[:int((repeats > 0).sum())].tolist():
            pattern = tuple(int(x) for x in patterns[i] if x)
            n = min(int(repeats[i]), *(int(left[x]) // pattern.count(x) for x in pattern))
            if n > 0:
                for x in pattern:
                    left[x] -= n
                chosen[pattern] += n
    fitted = [*chosen.items(), *best_fit(left, capacity)]
    best = min((fitted, alone), key=lambda p: sum(n for _, n in p))
    return [((capacity,), full)] * bool(full) + best


def slots(packed: list[tuple[tuple[int, ...], int]], capacity: int) -> tuple[np.ndarray, ...]:
    """Sorted (length, first number) keys, and for each the sequence of that number and the offset in it."""
    taken = np.zeros(capacity + 1, np.int64)
    rows, base = [], 0
    for pattern, n in packed:
        at = 0
        for length in pattern:
            rows.append((length, int(taken[length]), base, at))
            taken[length] += n
            at += length
        base += n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return table[:, 0] << 48 | table[:, 1], table[:, 1], table[:, 2], table[:, 3]


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null or empty
    text is its end id alone; a text of any length is cut into full pieces; repeated rows are packed as often
    as they stand there; null ids are kept; other columns are ignored; an empty table gives an empty one.

    The driver sees one count per length and makes a plan whose size depends on ``capacity`` only.
    """
    rows = materialize(with_lanes(pieces(docs, path, capacity)), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for r in rows.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    keys, first, sequence, offset = slots(plan(counts, capacity), capacity)

    def place(batches):
        for batch in batches:
            length, number = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "number"))
            at = np.searchsorted(keys, length << 48 | number, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence[at] + number - first[at]), pa.array(offset[at])],
                [*batch.schema.names[:5], "sequence_id", "offset"])

    dealt = numbered(rows, counts.tolist(), "length", ["doc_id", "piece", "ids_crc32"], "number")
    return dealt.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(
        place, PIECES + ", sequence_id long, offset long")
