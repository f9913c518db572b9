"""Benchmark decontamination by latent semantic retrieval and checks of word order.

Texts and items are cut into passages of words, weighted by term frequency and inverse passage frequency of
hashed words, and projected on the leading right singular vectors of the passages. Passages whose cosine
with a piece of an item is high are candidates; a longest common subsequence of words and a check for the
item's last sentence decide.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bytes_of, map_texts, materialize, row_chunks, text_column
from millrace.llm.word_bytes import Words

FEATURES = 1 << 15   # hash buckets of words
RANK = 64
SPARE = 8            # more directions than RANK while the basis is found
ROUNDS = 2           # power iterations
BLOCK = 12           # words; a passage is two blocks, and the next begins a block later
COSINE = 0.5
OVERLAP = 0.35       # of the weight of a piece's words must be in the passage
LEAST = 0.6          # of an item's words in order, within a stretch of 1.5 times its length
SURE = 0.8           # from which the last sentence need not be found
ANSWER = 0.75        # of the last sentence's words in order
SLOTS = 1 << 10      # of the words of a passage, for a quick look at what it may share
ITEMS = 5000         # items that one pass over the documents looks for
CHUNK = 1 << 18
ROWS = 1 << 10       # that are added up at a time
PASSAGES = 1 << 19   # of a task that adds up products
SHORT = 4            # values of a term in a chunk that are added without reduceat
SENTENCE = re.compile(r"(?<=[.!?])\s+")


def passage_blocks(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks of BLOCK words, each row beginning a new one, and each row's first block."""
    counts = np.diff(first)
    blocks = -(-counts // BLOCK)
    at = np.r_[0, np.cumsum(blocks)]
    inside = np.arange(at[-1]) - np.repeat(at[:-1], blocks)
    return np.repeat(first[:-1], blocks) + inside * BLOCK, at


def passages(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first block, begin in words) of each passage: two blocks, or the only one of a short row."""
    starts, at = passage_blocks(first)
    rows = np.repeat(np.arange(len(first) - 1), np.diff(at))
    index = np.arange(len(starts))
    lone = at[rows + 1] - at[rows] == 1
    keep = lone | (index + 1 < at[rows + 1])  # the last of several blocks is in the passage before
    return rows[keep], index[keep], starts[keep]


def in_blocks(values: np.ndarray, first: np.ndarray, missing: int) -> np.ndarray:
    """A row of BLOCK values per block, ``missing`` past the end of the last block of a row."""
    starts, at = passage_blocks(first)
    if not len(starts):
        return np.zeros((0, BLOCK), values.dtype)
    rows = np.repeat(np.arange(len(first) - 1), np.diff(at))
    where = starts[:, None] + np.arange(BLOCK)
    return np.where(where < first[rows + 1][:, None], values[np.minimum(where, len(values) - 1)], values.dtype.type(missing))


def in_passages(blocks: np.ndarray, first: np.ndarray, missing: int) -> np.ndarray:
    """A row of 2 * BLOCK values per passage."""
    rows, block, _ = passages(first)
    _, at = passage_blocks(first)
    second = np.full((len(rows), BLOCK), missing, blocks.dtype)
    two = at[rows + 1] - at[rows] > 1
    second[two] = blocks[block[two] + 1]
    return np.concatenate([blocks[block], second], 1)


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(FEATURES - 1)).astype(np.int32)


def worded(texts: DataFrame) -> DataFrame:
    """The buckets of the words of each text, two bytes each."""
    def run(batches):
        words = Words(marks=False)
        for batch in batches:
            data, starts = bytes_of(pc.utf8_lower(batch.column(0)))
            out = []
            for a, b in row_chunks(starts, CHUNK):
                hashes, first, _, _ = words(data[starts[a]:starts[b]], starts[a:b + 1] - starts[a])
                raw = buckets(hashes).astype("<u2").tobytes()
                out += [raw[2 * i:2 * j] for i, j in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["words"])

    return materialize(map_texts(texts.select(text_column().alias("t")), run, "words binary"), "words")


def word_chunks(column: pa.Array):
    """(blocks, first word of each row) of rows of ``worded``, in chunks."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, "<u2") if data is not None else np.zeros(0, np.uint16)
    for a, b in row_chunks(starts, 2 * CHUNK):
        first = (starts[a:b + 1] - starts[a]) // 2
        yield in_blocks(whole[starts[a] // 2:starts[b] // 2], first, FEATURES), first


def passage_counts(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Passages (of consecutive, not overlapping blocks) that hold each bucket, and their number, over all rows."""
    def run(batches):
        total, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for block, _ in word_chunks(batch.column(0)):
                block = np.sort(block, 1)
                new = np.ones(block.shape, bool)
                new[:, 1:] = block[:, 1:] != block[:, :-1]
                total += np.bincount(block[new], minlength=FEATURES + 1)[:FEATURES]
                n += len(block)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, some].astype(np.int64)), pa.array(np.r_[n, total[some]])], ["bucket", "n"])

    counts = rows.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    found, total = np.zeros(FEATURES, np.int64), 0
    for bucket, n in zip(counts["bucket"].to_pylist(), counts["n"].to_pylist()):
        if bucket < 0:
            total = n
        else:
            found[bucket] = n
    return found, total


def weights(counts: np.ndarray, total: int) -> np.ndarray:
    return np.log((1 + total) / (1 + counts)).astype(np.float32)


class Listed:
    """Passages as rows of terms and values."""

    def __init__(self, batch):
        terms, values = batch.column(0), batch.column(1)
        self.row = np.repeat(np.arange(len(terms)), np.diff(terms.offsets.to_numpy()))
        self.terms, self.values = terms.flatten().to_numpy(), values.flatten().to_numpy()

    def times(self, basis: np.ndarray) -> np.ndarray:
        out = np.zeros((int(self.row[-1]) + 1 if len(self.row) else 0, basis.shape[1]), np.float32)
        if len(self.row):
            heads = np.flatnonzero(np.r_[True, self.row[1:] != self.row[:-1]])
            out[self.row[heads]] = np.add.reduceat(basis[self.terms] * self.values[:, None], heads, axis=0)
        return out

    def add_transposed(self, out: np.ndarray, total: np.ndarray) -> None:
        add_by_term(self.terms, in_pairs(out[self.row] * self.values[:, None]), total.T)

    @classmethod
    def of(cls, batch):
        for first in range(0, batch.num_rows, 2000):
            yield cls(batch.slice(first, 2000))


def block_sums(block: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The sum of the table's rows of each block, for few blocks at a time: their rows stay in the processor's cache."""
    sums = np.empty((len(block), table.shape[1]), np.float32)
    for a in range(0, len(block), ROWS):
        words = np.ascontiguousarray(block[a:a + ROWS].T, np.int64)
        own = table.take(words[0], 0)
        for k in range(1, BLOCK):
            own += table.take(words[k], 0)
        sums[a:a + ROWS] = own
    return sums


class Passages:
    """All passages of whole texts, weighted, each of length one. A passage is the sum of its two blocks by its
    length, so products are taken block by block."""

    def __init__(self, block: np.ndarray, first: np.ndarray, idf: np.ndarray):
        rows, self.index, _ = passages(first)
        _, at = passage_blocks(first)
        self.two = at[rows + 1] - at[rows] > 1
        self.block, self.idf = block, np.r_[idf, np.float32(0)]
        words = np.sort(in_passages(block, first, FEATURES), 1)
        # Of a word that stands there k times, the last has rank k: the square of its count is the sum of 2 * rank - 1.
        new = np.ones(words.shape, bool)
        new[:, 1:] = words[:, 1:] != words[:, :-1]
        spot = np.arange(words.shape[1], dtype=np.int8)
        rank = spot - np.maximum.accumulate(new * spot, axis=1) + np.int8(1)
        length = np.sqrt(np.multiply(np.square(self.idf).take(words), 2 * rank - 1, dtype=float).sum(1))
        self.scale = np.divide(1, length, out=np.zeros(len(length)), where=length > 0).astype(np.float32)[:, None]

    def times(self, basis: np.ndarray) -> np.ndarray:
        """``basis`` comes with its rows weighted and a row of zeros, as from ``weighted``."""
        sums = block_sums(self.block, basis)
        out = sums[self.index]
        out[self.two] += sums[self.index[self.two] + 1]
        return out * self.scale

    def add_transposed(self, out: np.ndarray, total: np.ndarray) -> None:
        out *= self.scale
        sums = np.zeros((len(self.block), out.shape[1]), np.float32)
        sums[self.index] = out
        after = np.zeros(len(self.block), bool)  # blocks that are the second of the passage from the block before
        after[self.index[self.two] + 1] = True
        where = np.flatnonzero(self.block < FEATURES)
        terms = self.block.ravel()[where]
        order = np.argsort(terms, kind="stable")  # two bytes: by counting
        terms, rows = terms[order].astype(np.int64), where[order] // BLOCK
        if len(terms):
            found, rows, add = sums_by_run(terms, rows)
            weight = self.idf[found]
            # A pair of columns after the other, which is many times as fast as sums of rows by term.
            room = np.empty(len(rows), np.complex64)
            for own, one in zip(total, np.ascontiguousarray(in_pairs(sums).T)):
                column = one.copy()
                column[1:] += one[:-1] * after[1:]
                own[found] += add(column.take(rows, out=room, mode="clip")) * weight

    @staticmethod
    def reader(idf: np.ndarray):
        def of(batch):
            for block, first in word_chunks(batch.column(0)):
                yield Passages(block, first, idf)

        return of


def sums_by_run(terms: np.ndarray, rows: np.ndarray):
    """(term of each run of equal terms, ``rows`` in another order, a function from values in that order to the sum of each
    run). Runs of up to SHORT values, most of all, are added together by their length, in the order in which reduceat adds:
    it takes longer to begin a run than to add it."""
    heads = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]])
    sizes = np.diff(np.r_[heads, len(terms)])
    short = [heads[sizes == k] for k in range(1, SHORT + 1)]
    long = sizes > SHORT
    found = terms[np.concatenate([*short, heads[long]])]
    spots = [(own[None, :] + np.arange(k)[:, None]).ravel() for k, own in enumerate(short, 1)]
    order = np.concatenate([*spots, np.flatnonzero(np.repeat(long, sizes))])
    begin = (np.cumsum(sizes[long]) - sizes[long]) + sum(map(len, spots))

    def add(values: np.ndarray) -> np.ndarray:
        out, at = [], 0
        for k, own in enumerate(short, 1):
            first, *rest = values[at:at + k * len(own)].reshape(k, -1)
            out.append(first + reduce(np.add, rest) if rest else first)
            at += k * len(own)
        return np.concatenate([*out, np.add.reduceat(values, begin)] if len(begin) else out)

    return found, rows[order], add


def in_pairs(rows: np.ndarray) -> np.ndarray:
    """Two columns as one of complex numbers, which numpy moves and adds as fast as one of the two."""
    return np.ascontiguousarray(rows, np.float32).view(np.complex64)


def add_by_term(terms: np.ndarray, rows: np.ndarray, total: np.ndarray) -> None:
    if len(terms):
        order = np.argsort(terms, kind="stable")
        t = terms[order]
        heads = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
        total[t[heads]] += np.add.reduceat(rows[order], heads, axis=0)


def weighted(basis: np.ndarray, idf: np.ndarray | None) -> np.ndarray:
    """What passages are multiplied by: the basis itself, or by weight and with a row of zeros."""
    # Row by row in memory, which singular vectors are not: rows are what is taken.
    return basis if idf is None else np.ascontiguousarray(np.concatenate([basis * idf[:, None], np.zeros((1, basis.shape[1]))]), np.float32)


def times_transposed(rows: DataFrame, basis: np.ndarray, idf: np.ndarray | None = None, tasks: int | None = None) -> np.ndarray:
    """A' A basis, A being the passages: each task sends its rows of the product, summed by term before the
    driver takes the FEATURES by rank result. A task sends at most a row per term, so ``tasks`` should follow the
    number of passages, not that of files."""
    columns = basis.shape[1]
    basis = np.pad(basis, ((0, 0), (0, columns % 2)))
    width, read, table = basis.shape[1], Listed.of if idf is None else Passages.reader(idf), weighted(basis, idf)

    def run(batches):
        total = np.zeros((width // 2, FEATURES), np.complex128)
        for batch in batches:
            for part in read(batch):
                part.add_transposed(part.times(table), total)
        total = np.ascontiguousarray(total.T).view(np.float64).astype(np.float32)
        some = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.FixedSizeListArray.from_arrays(
            total[some].ravel(), width).cast(pa.list_(pa.float32()))], ["term", "v"])

    rows = rows.coalesce(tasks) if tasks else rows
    summed = rows.mapInArrow(run, "term long, v array<float>").groupBy("term").agg(
        *[F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(width)]).toArrow()
    found = np.zeros(basis.shape)
    found[summed["term"].to_numpy()] = np.stack([summed[f"v{i}"].to_numpy() for i in range(width)], 1)
    return found[:, :columns]


def latent_basis(rows: DataFrame, rank: int = RANK, seed: int = 11, idf: np.ndarray | None = None, total: int | None = None) -> np.ndarray:
    """Right singular vectors of the passages (rows of terms and values, or with ``idf`` rows of words, ``total`` passages in
    all), each divided by its singular value so that frequent topics do not outweigh the rest: a randomised range, power
    iterations, and the spectrum from the last product itself.

    With Q the range before it and B = A'A Q, the product B (Q'B)^-1 B' stands for A'A: its eigenvectors lie in the
    range of B, which is one power iteration better than Q, and no further pass over the passages is needed.

    A row is the place of a bucket's words in the latent space. Passages add them up at equal length, times the
    weight: otherwise frequent words round an inserted passage drown its rare ones, which the leading vectors
    hardly reach."""
    tasks = -(-total // PASSAGES) if total else None
    basis = np.random.default_rng(seed).normal(size=(FEATURES, rank + SPARE))
    for _ in range(ROUNDS):
        basis = np.linalg.qr(basis)[0].astype(np.float32)
        product = times_transposed(rows, basis, idf, tasks)
        basis, before = product, basis
    core = before.T.astype(float) @ product
    values, turns = np.linalg.eigh((core + core.T) / 2)
    lead = values > 1e-9 * max(values.max(), 1e-30)
    vectors, sizes, _ = np.linalg.svd(product @ (turns[:, lead] / np.sqrt(values[lead])), full_matrices=False)
    # The squares of these sizes are the eigenvalues, so the sizes themselves are the singular values of the passages.
    sizes = sizes[:rank]
    some = sizes > 1e-5 * max(sizes.max(initial=0), 1e-30)
    return (vectors[:, :rank][:, some] / sizes[some]).astype(np.float32)


def units(vectors: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.square(vectors).sum(1, keepdims=True))
    return np.divide(vectors, norms, out=np.zeros_like(vectors), where=norms > 0)


def passage_vectors(hashes: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Unit vector of each passage; ``table`` holds weight times basis by bucket, and zeros in one more row."""
    sums = block_sums(in_blocks(buckets(hashes), first, FEATURES), table)
    rows, index, _ = passages(first)
    total = sums[index]
    _, at = passage_blocks(first)
    two = at[rows + 1] - at[rows] > 1
    total[two] += sums[index[two] + 1]
    return units(total)


def ordered_share(mine: list[int], theirs: list[int]) -> float:
    """Length of the longest common subsequence as a share of ``mine`` (bit-parallel)."""
    where: dict[int, int] = {}
    for j, w in enumerate(mine):
        where[w] = where.get(w, 0) | 1 << j
    full = v = (1 << len(mine)) - 1
    for w in theirs:
        u = v & where.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return (len(mine) - v.bit_count()) / len(mine) if mine else 0.0


def read_items(items: DataFrame) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(item_id, its words, words of its last sentence); items without words cannot leak."""
    words, out = Words(marks=False), []
    for r in items:
        text = (r["text"] or "").strip()
        parts = [p for p in SENTENCE.split(text) if p]

        def hashed(t: str) -> np.ndarray:
            raw = np.frombuffer(t.lower().encode("utf-8", "replace"), np.uint8)
            return words(raw, np.array([0, len(raw)]))[0]

        own = hashed(text)
        if r["item_id"] is not None and len(own):
            last = next((h for h in (hashed(p) for p in reversed(parts)) if len(h)), own)
            out.append((r["item_id"], own, last))
    return out


class Searched:
    """The items of a pass, cut into passages."""

    def __init__(self, items: list[tuple[int, np.ndarray, np.ndarray]], table: np.ndarray, idf: np.ndarray):
        self.items = items
        # Pieces follow each other without overlap; the last one ends with the item.
        cuts = [(i, own[s:s + 2 * BLOCK]) for i, (_, own, _) in enumerate(items)
                for s in dict.fromkeys([*range(0, max(1, len(own) - 2 * BLOCK + 1), 2 * BLOCK), max(0, len(own) - 2 * BLOCK)])]
        self.owner = np.array([i for i, _ in cuts])
        words = np.concatenate([w for _, w in cuts])
        first = np.r_[0, np.cumsum([len(w) for _, w in cuts])]
        # One passage per piece, for none is longer than two blocks.
        self.vectors = passage_vectors(words, first, table)
        self.words = in_passages(in_blocks((words >> np.uint64(32)).astype(np.int64), first, -1), first, -1)
        self.slots = self.words & (SLOTS - 1)
        weight = in_passages(in_blocks(idf[buckets(words)], first, 0), first, 0)
        self.weight = weight / np.maximum(weight.sum(1, keepdims=True), 1e-9)


def best_stretch(own: np.ndarray, region: np.ndarray) -> tuple[float, int]:
    """Largest ordered share of an item in stretches of 1.5 times its length, and where that begins."""
    size = max(len(own) * 3 // 2, 1)
    step = max(1, len(own) // 4)
    mine, theirs = own.tolist(), region.tolist()
    best = (0.0, 0)
    for s in range(0, max(1, len(theirs) - size + step), step):
        share = ordered_share(mine, theirs[s:s + size])
        if share > best[0]:
            best = (share, s)
    return best


def leaks_of(hashes, first, table, looked: Searched, options):
    """(row, item number, cosine, share, answer share, first word) of the leaks in a chunk, the best of each row
    and item."""
    cosine, least, sure, answer = options
    rows, _, begin = passages(first)
    if not len(rows):
        return []
    vectors = passage_vectors(hashes, first, table)
    pieces = len(looked.owner)

    def words_of(some: np.ndarray) -> np.ndarray:
        """The words of some passages, -2 past the end of their rows: few passages come near a piece."""
        where, end = begin[some, None] + np.arange(2 * BLOCK), first[rows[some] + 1][:, None]
        return np.where(where < end, (hashes[np.minimum(where, len(hashes) - 1)] >> np.uint64(32)).astype(np.int64), -2)

    near: dict[tuple[int, int], list[tuple[float, int]]] = {}
    for a in range(0, len(rows), 2048):
        close = (vectors[a:a + 2048] @ looked.vectors.T).ravel()
        pairs = np.flatnonzero(close >= cosine)
        row = pairs // pieces
        new = np.r_[True, row[1:] != row[:-1]] if len(row) else np.zeros(0, bool)
        here, spot = row[new], np.cumsum(new) - 1  # the passages that are close to a piece, and which of them a pair has
        there_slots = np.zeros((len(here), SLOTS), bool)
        words = words_of(here + a)
        there_slots[np.arange(len(here))[:, None], words & (SLOTS - 1)] = True
        for k in range(0, len(pairs), 8192):
            some, own = pairs[k:k + 8192], spot[k:k + 8192]
            # Slots in common bound the words in common.
            slots = there_slots[own[:, None], looked.slots[some % pieces]]
            may = (slots * looked.weight[some % pieces]).sum(1) >= OVERLAP - 1e-6
            some, own = some[may], own[may]
            where, piece = some // pieces + a, some % pieces
            # Words in common bound what can be in order.
            there = (looked.words[piece][:, :, None] == words[own][:, None, :]).any(2)
            for i in np.flatnonzero((there * looked.weight[piece]).sum(1) >= OVERLAP).tolist():
                key = int(rows[where[i]]), int(looked.owner[piece[i]])
                near.setdefault(key, []).append((float(close[some[i]]), int(where[i])))
    found = []
    for (row, item), spots in sorted(near.items()):
        _, own, last = looked.items[item]
        best, done = None, set()
        for score, w in sorted(spots, reverse=True):
            if w in done:
                continue
            done.add(w)
            lo, hi = max(int(first[row]), int(begin[w]) - len(own)), min(int(first[row + 1]), int(begin[w]) + 2 * BLOCK + len(own))
            share, s = best_stretch(own, hashes[lo:hi])
            if share < least:
                continue
            answered = ordered_share(last.tolist(), hashes[lo:hi].tolist())
            if share < sure and answered < answer:
                continue
            if best is None or share > best[1]:
                best = (score, share, answered, lo + s - int(first[row]))
            if share == 1:
                break
        if best:
            found.append((row, item, *best))
    return found


def item_passes(docs: DataFrame, benchmark: DataFrame):
    """(table, items) for passes over the documents of at most about ITEMS items each."""
    wanted = benchmark.select(F.col("item_id").cast("long"), "text").where("item_id is not null and text is not null").distinct()
    n = wanted.count()
    if not n:
        return
    rows = worded(docs)
    counts, total = passage_counts(rows)
    if not total:
        return
    idf, passes = weights(counts, total), -(-n // ITEMS)
    basis = latent_basis(rows.unionByName(worded(wanted)), idf=idf, total=total)
    table = weighted(units(basis), idf)
    for k in range(passes):
        part = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        items = read_items(part.orderBy("item_id", "text").collect())
        if items:
            yield table, Searched(items, table, idf)


def leaks_in(column, words: Words, table: np.ndarray, looked: Searched, options) -> list[tuple]:
    """Leaks in a column of texts; rows are numbered from its first."""
    data, starts = bytes_of(pc.utf8_lower(column))
    rows = []
    for a, b in row_chunks(starts, CHUNK):
        hashes, first, _, _ = words(data[starts[a]:starts[b]], starts[a:b + 1] - starts[a])
        rows += [(a + r[0], *r[1:]) for r in leaks_of(hashes, first, table, looked, options)]
    return rows


def find_leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, least: float = LEAST,
               sure: float = SURE, answer: float = ANSWER) -> DataFrame:
    """Documents that hold a benchmark item, word for word or reworded.

    Returns doc_id, item_id, cosine (of the latent vectors), share (of the item's words found in order), answer (of
    its last sentence's words) and first_word (where the stretch begins that holds them); a row per row of
    ``docs`` and item. An item has leaked if ``share`` is at least ``sure``, or at least ``least`` with ``answer`` of
    the last sentence. Words are compared without case and without ASCII punctuation.

    Null and empty texts and items never match; texts of any length are read whole; repeated rows of documents
    give repeated rows, repeated items count once per id and text; null item ids are left out, null doc ids
    stay; other columns are ignored; either table being empty gives an empty result.

    Passage frequencies count all documents, and the basis is fitted to all their passages and those of the items. Items are looked for in passes of ITEMS, so what is sent to tasks stays bounded.
    """
    schema = (f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id long, cosine double, share double, "
              "answer double, first_word long")
    out = docs.sparkSession.createDataFrame([], schema)
    for table, looked in item_passes(docs, benchmark):
        out = out.unionByName(searched(docs, table, looked, (cosine, least, sure, answer), schema))
    return out


def searched(docs: DataFrame, table: np.ndarray, looked: Searched, options, schema: str) -> DataFrame:
    def run(batches):
        words = Words(marks=False)
        for batch in batches:
            rows = leaks_in(batch.column(1), words, table, looked, options)
            if rows:
                row, item, *rest = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array([looked.items[i][0] for i in item], pa.int64()),
                     *(pa.array(c, pa.float64()) for c in rest[:3]), pa.array(rest[3], pa.int64())],
                    ["doc_id", "item_id", "cosine", "share", "answer", "first_word"])

    return map_texts(docs.select("doc_id", "text"), run, schema)


def without_leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, least: float = LEAST,
                  sure: float = SURE, answer: float = ANSWER) -> DataFrame:
    """The rows of ``docs`` in which ``find_leaks`` finds nothing, all columns kept, in one pass per ITEMS items."""
    out = docs
    for table, looked in item_passes(docs, benchmark):
        out = map_texts(out, dropping(out.columns.index("text"), table, looked, (cosine, least, sure, answer)), docs.schema)
    return out


def dropping(text: int, table: np.ndarray, looked: Searched, options):
    def run(batches):
        words = Words(marks=False)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[r[0] for r in leaks_in(batch.column(text), words, table, looked, options)]] = False
            yield batch.filter(pa.array(keep))

    return run
