"""Removal of byte strings that stand earlier in the corpus.

1. Every window of ``length`` bytes is named by the least hash of its GRAM-byte pieces (its anchor). Equal windows
   have equal anchors, so windows whose anchor stands nowhere else are done with.
2. The others are cut into pieces at places that depend on their content, and dealt to shards by the least anchor
   of the piece, so copies mostly meet. Each shard gets a suffix array with common prefixes, which tells the first
   window of each kind; the later ones are removed.
3. First windows whose anchor also stands outside their shard are merged across shards by anchor: they are sorted
   by hash, each finds its kind by binary search, bytes are compared, and all but the earliest are removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bytes_of, map_texts, materialize, row_chunks, text_column
from millrace.llm.suffix_array import repeated, words_at
from millrace.llm.word_bytes import mixed, powers

LENGTH = 100
GRAM = 32
CHUNK = 1 << 18
SHARD = 1 << 19        # bytes of one suffix array
PIECE = 256            # runs in a piece at most
CUT = 31               # a piece ends before an anchor that has these bits clear
DEAL = 4096            # rows of one anchor that are dealt to one shard
HOT = 2000             # an anchor that stands more often is merged window by window
MEMORY = 1 << 21       # runs of one task that are looked through for repeats at a time
PLACE, TAGS = 1 << 31, 1 << 32        # a place is tag * PLACE + byte; no text has more than 2^31 - 1 bytes
BITS, BITMAP = 1 << 24, 1 << 15


class Anchors:
    """Least gram hash of every window in a buffer."""

    def __init__(self, length: int):
        self.length, self.grams = length, length - GRAM + 1
        self.up, self.down = powers(1 << 16)

    def sums(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if n + 1 > len(self.up):
            self.up, self.down = powers(2 * (n + 1))
        out = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=out[1:])
        return out

    def hashes(self, data: np.ndarray, size: int) -> np.ndarray:
        """Hash of each ``size`` bytes."""
        sums = self.sums(data)
        return mixed((sums[size:] - sums[:-size]) * self.down[:len(data) - size + 1])

    def runs(self, data: np.ndarray, starts: np.ndarray):
        """(row, first window, windows, anchor) of runs of windows with their anchor at one place, inside rows. Of
        several equal anchors in a window the first counts."""
        if len(data) < self.length:
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
        grams = self.hashes(data, GRAM)
        least, size = grams, 1
        while size < self.grams:
            step = min(size, self.grams - size)
            least = np.minimum(least[:-step], least[step:])
            size += step
        # The anchor changes, or the window has gone past it and meets an equal one.
        change = np.r_[True, (least[1:] != least[:-1]) | (grams[:len(least) - 1] == least[:-1])]
        inner = starts[(starts > 0) & (starts < len(least))]
        change[inner] = True
        first = np.flatnonzero(change)
        row = np.searchsorted(starts, first, "right") - 1
        stop = np.minimum(np.r_[first[1:], len(least)], starts[row + 1] - self.length + 1)
        good = stop > first
        return row[good], (first - starts[row])[good], (stop - first)[good], least[first[good]]


def places(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc, tag and text of each document, in whose order of doc and tag they count; and doc, tag, n_bytes and own of each
    row: 1 for a null id or else 0, and the sha256 of the text. A null id comes last, after the largest id, with which it
    shares its number. Where a number stands once, its tag is 0. Otherwise rows that repeat an id and a text are folded to
    one document, and the tag numbers the different documents of a number in order of own."""
    text = text_column()
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    sha = F.concat(F.when(F.col("doc_id").isNull(), "1").otherwise("0"), F.sha2(text.cast("binary"), 256))
    once = docs.select(doc.alias("doc"), F.lit(0).cast("long").alias("tag"), text.alias("text"))
    if once.groupBy("doc").count().where("count > 1").isEmpty():
        return once, docs.select(doc.alias("doc"), F.lit(0).cast("long").alias("tag"), F.octet_length(text).cast("long").alias("n_bytes"), sha.alias("own"))
    every = materialize(docs.select(doc.alias("doc"), F.octet_length(text).cast("long").alias("n_bytes"), sha.alias("own")), "rows")
    # The texts of a hot id are numbered in deals by the first digits of the hash, which are few whatever the id.
    kinds = every.select("doc", "own").distinct().withColumn("deal", F.substring("own", 1, 5))
    before = Window.partitionBy("doc").orderBy("deal").rowsBetween(Window.unboundedPreceding, 0)
    deals = kinds.groupBy("doc", "deal").agg(F.count("*").alias("n")).withColumn("shift", F.sum("n").over(before) - F.col("n"))
    inside = F.row_number().over(Window.partitionBy("doc", "deal").orderBy("own")) - 1
    tags = materialize(kinds.withColumn("inside", inside).join(deals, ["doc", "deal"]).select(
        "doc", "own", (F.col("inside") + F.col("shift")).cast("long").alias("tag")), "tags")
    if (tags.agg(F.max("tag")).first()[0] or 0) >= TAGS:
        raise ValueError(f"an id has more than {TAGS} different texts")
    texts = docs.select(doc.alias("doc"), sha.alias("own"), text.alias("text")).groupBy("doc", "own").agg(F.first("text").alias("text"))
    return materialize(texts.join(tags, ["doc", "own"]).select("doc", "tag", "text"), "texts"), every.join(tags, ["doc", "own"])


def suspects(rows: DataFrame, length: int) -> DataFrame:
    """(doc, tag, runs) with the runs whose anchor stands elsewhere, too: place, windows, anchor, n.

    A task sends one row per different anchor to the count, however often it stands there. For that row n is how
    often the anchor stands in all; other rows of the task carry minus the number that the task knows, or if there
    are more than HOT, minus that of all.
    """
    def run(batches):
        anchors, held, size = Anchors(length), [], 0

        def found():
            doc, place, windows, anchor = (np.concatenate(c) for c in zip(*held))
            order = np.argsort(anchor, kind="stable")
            doc, place, windows, anchor = doc[order], place[order], windows[order], anchor[order]
            head = np.r_[True, anchor[1:] != anchor[:-1]] if len(anchor) else np.zeros(0, bool)
            at = np.flatnonzero(head)
            often = np.repeat(np.diff(np.r_[at, len(anchor)]), np.diff(np.r_[at, len(anchor)]))
            # Other rows than the first are dealt anywhere: they are known to be repeated.
            spread = (mixed(doc.view(np.uint64) ^ mixed(place.view(np.uint64))) >> np.uint64(34)).astype(np.int32) + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(np.where(head, 0, spread).astype(np.int32)), pa.array(np.where(head, often, -often)),
                 pa.array(doc), pa.array(place), pa.array(windows.astype(np.int32))],
                ["anchor", "deal", "n", "doc", "place", "windows"])

        for batch in batches:
            data, starts = bytes_of(batch.column(2))
            doc, tag = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for a, b in row_chunks(starts, CHUNK):
                row, first, windows, anchor = anchors.runs(data[starts[a]:starts[b]], starts[a:b + 1] - starts[a])
                held.append((doc[a + row], tag[a + row] * PLACE + first, windows, anchor))
                size += len(row)
                if size > MEMORY:
                    yield found()
                    held, size = [], 0
        if held:
            yield found()

    runs = map_texts(rows, run, "anchor long, deal int, n long, doc long, place long, windows int")
    total = F.sum(F.greatest("n", F.lit(0))).over(Window.partitionBy("anchor", "deal"))
    again = materialize(runs.withColumn("total", total).where("n < 0 or total > 1").select(
        "anchor", F.when(F.col("n") > 0, F.col("total")).otherwise(F.col("n")).alias("n"), "doc", "place", "windows"), "again")
    # All rows of a hot anchor must know it, for they are merged in another way.
    hot = again.where(F.col("n") > HOT).groupBy("anchor").agg(F.max("n").alias("total"))
    others = again.where("n < 0").join(hot, "anchor", "left").withColumn("n", F.coalesce(-F.col("total"), F.col("n"))).drop("total")
    item = F.struct("place", "windows", "anchor", "n")
    return again.where("n > 0").unionByName(others).groupBy("doc", F.shiftright("place", 31).alias("tag")).agg(
        F.array_sort(F.collect_set(item)).alias("runs"))


def row_bit() -> Column:
    return F.pmod(F.xxhash64("doc", "tag"), F.lit(BITS))


def bits_of(rows: DataFrame) -> np.ndarray:
    """A bit for the hash of every (doc, tag): of bounded size, and at worst all ones."""
    found = np.zeros((BITS // BITMAP, BITMAP // 8), np.uint8)
    for r in rows.groupBy(F.floor(row_bit() / BITMAP).alias("i")).agg(
            F.bitmap_construct_agg((row_bit() % BITMAP).cast("long")).alias("bits")).collect():
        found[r["i"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return found.ravel()


def squeezed(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of ``wanted`` (and a few others, which a join drops), compressed for the shuffle."""
    bits = bits_of(wanted)

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            h = batch.column(3).to_numpy()
            batch = batch.filter(pa.array(bits[h >> 3] >> (h & 7) & 1 == 1))
            data, starts = bytes_of(batch.column(2))
            raw = [pack.compress(data[a:b].tobytes()) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw, pa.binary())], ["doc", "tag", "raw"])

    return map_texts(rows.withColumn("h", row_bit()), run, "doc long, tag long, raw binary")


def unpacked(raw: list[bytes]) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor()
    return [unpack.decompress(x) for x in raw]


PIECES = "key long, salt int, doc long, place long, raw binary, windows array<int>, anchors array<long>, n array<long>"


def pieces(rows: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """Stretches of suspect windows with their bytes, cut where the content says so."""
    def run(batches):
        for batch in batches:
            out = []
            runs = batch.column(3)
            flat, offsets = runs.flatten(), runs.offsets.to_numpy()
            offsets = offsets - offsets[0]
            place, windows, anchor, n = (flat.field(i).to_numpy() for i in range(4))
            for i, (doc, tag, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), unpacked(batch.column(2).to_pylist()))):
                s = slice(offsets[i], offsets[i + 1])
                p, w, h, c = place[s] - tag * PLACE, windows[s].astype(np.int64), anchor[s], n[s]
                cut = np.r_[True, (p[1:] != p[:-1] + w[:-1]) | (h[1:] & CUT == 0)]
                at = np.flatnonzero(cut)
                at = np.concatenate([np.arange(a, b, PIECE) for a, b in zip(at, np.r_[at[1:], len(p)])])
                for a, b in zip(at.tolist(), [*at[1:].tolist(), len(p)]):
                    lead = a + int(np.argmin(h[a:b]))
                    shares = -(-abs(int(c[lead])) // DEAL)
                    begin, end = int(p[a]), int(p[b - 1] + w[b - 1]) + length - 1
                    out.append((int(h[lead]), int(mixed(np.array([doc], np.int64).view(np.uint64))[0] % np.uint64(shares)) if shares > 1 else 0,
                                doc, tag * PLACE + begin, text[begin:end], w[a:b], h[a:b], c[a:b]))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = list(zip(*out)) or [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["key", "salt", "doc", "place", "raw", "windows", "anchors", "n"])

    found = materialize(found, "suspects")
    joined = squeezed(rows, found).join(found, ["doc", "tag"]).select("doc", "tag", "raw", "runs")
    return map_texts(joined, run, PIECES)


def spans(doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, first, last) of stretches of consecutive places."""
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + 1)] if len(doc) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    last = np.r_[at[1:], len(doc)] - 1
    return doc[at], place[at], place[last] if len(at) else place[:0]


SHARDED = "doc long, first long, last long, deal long, raw binary"


def shard_rows(parts: list[tuple], length: int) -> list[tuple]:
    """Stretches to remove (no raw), and stretches of first windows to merge with other shards (raw).

    The parts are put in the order of the corpus, so that the first window of a kind is the first in the buffer.
    """
    parts = sorted({(p[2], p[3]): p for p in parts}.values(), key=lambda p: (p[2], p[3]))
    text = np.frombuffer(b"".join(p[4] for p in parts), np.uint8)
    sizes = np.array([len(p[4]) for p in parts])
    begin = np.r_[0, np.cumsum(sizes)[:-1]]
    windows = np.concatenate([p[5] for p in parts])
    anchors = np.concatenate([p[6] for p in parts])
    n = np.concatenate([p[7] for p in parts])
    runs_of = np.array([len(p[5]) for p in parts])
    part_of_run = np.repeat(np.arange(len(parts)), runs_of)
    before = np.cumsum(windows) - windows
    run_start = begin[part_of_run] + before - np.repeat(before[np.cumsum(runs_of) - runs_of], runs_of)
    # Window starts, one after another, and the run of each.
    run_of = np.repeat(np.arange(len(windows)), windows)
    start = run_start[run_of] + np.arange(len(run_of)) - np.repeat(before, windows)
    first = np.full(len(text), len(text), np.int64)
    kinds = repeated(text, length)
    # Windows that run over the end of a part are no windows; the first of a kind is the first real one.
    np.minimum.at(first, kinds[start], start)
    later = first[kinds[start]] < start
    doc = np.array([p[2] for p in parts], np.int64)
    place = np.array([p[3] for p in parts], np.int64)
    part = part_of_run[run_of]
    where = place[part] + start - begin[part]
    out = [(int(d), int(a), int(b), None, None) for d, a, b in zip(*spans(doc[part[later]], where[later]))]
    _, inverse, here = np.unique(anchors, return_inverse=True, return_counts=True)
    open_run = (n < 0) | (here[inverse] < n)
    hot = np.abs(n) > HOT
    stay = np.flatnonzero(~later & open_run[run_of])
    new = np.r_[True, (run_of[stay[1:]] != run_of[stay[:-1]]) | (stay[1:] != stay[:-1] + 1) | hot[run_of[stay[1:]]]] if len(stay) else np.zeros(0, bool)
    heads = np.flatnonzero(new)
    hashed = None
    if len(heads) and hot[run_of[stay]].any():
        hashed = Anchors(length).hashes(text, length).view(np.int64)
    for a, b in zip(heads.tolist(), np.r_[heads[1:], len(stay)].tolist()):
        i, j = stay[a], stay[b - 1]
        r = run_of[i]
        s, e = int(start[i]), int(start[j]) + length
        out.append((int(doc[part[i]]), int(where[i]), int(where[j]), int(hashed[s]) if hot[r] else int(anchors[r]), text[s:e].tobytes()))
    return out


def sharded(parts: DataFrame, length: int) -> DataFrame:
    def table(rows):
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 5, kinds)],
                                          ["doc", "first", "last", "deal", "raw"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for i in range(5, 8):
                lists = batch.column(i)
                flat, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy()
                columns.append([flat[a:b] for a, b in zip(offsets - offsets[0], offsets[1:] - offsets[0])])
            for row in zip(*columns):
                # A piece of a repeated row follows its copy: they are one.
                if held and held[-1][2:4] == row[2:4]:
                    continue
                if size > SHARD:
                    last = held[-1]
                    yield table(shard_rows(held, length))
                    held, size = [], 0
                    if last[2:4] == row[2:4]:
                        continue
                held.append(row)
                size += len(row[4])
        if held:
            yield table(shard_rows(held, length))

    return map_texts(parts.repartition("key", "salt").sortWithinPartitions("key", "salt", "doc", "place"), run, SHARDED)


def merge_rows(doc: np.ndarray, first: np.ndarray, count: np.ndarray, deal: np.ndarray, raw: list[bytes], length: int):
    """(doc, first, last) of windows that stand earlier in another row of the same deal."""
    text = np.frombuffer(b"".join(raw), np.uint8)
    sizes = np.array([len(x) for x in raw])
    begin = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(raw)), count)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start, where = begin[row] + inside, first[row] + inside
    kind = mixed(Anchors(length).hashes(text, length)[start] ^ mixed(deal.view(np.uint64)[row]))
    order = np.lexsort((where, doc[row], kind))
    ranked = kind[order]
    kinds = ranked[np.r_[True, ranked[1:] != ranked[:-1]]]
    earliest = order[np.searchsorted(ranked, kinds)]
    head = earliest[np.searchsorted(kinds, kind)]
    later = np.flatnonzero(head != np.arange(len(head)))
    words = words_at(text, 8)
    steps = [*range(0, length - 8, 8), length - 8]
    same = np.ones(len(later), bool)
    for s in steps:
        same &= words[start[later] + s] == words[start[head[later]] + s]
    odd = later[~same]
    later = later[same]
    if len(odd):  # different windows of one hash: compare their bytes
        clash = np.isin(kind, kind[odd])
        seen, extra = {}, []
        for i in order[clash[order]].tolist():
            window = text[start[i]:start[i] + length].tobytes()
            if (int(deal[row[i]]), window) in seen:
                extra.append(i)
            seen.setdefault((int(deal[row[i]]), window), i)
        later = np.union1d(later[~clash[later]], np.array(extra, np.int64))
    return spans(doc[row[later]], where[later])


def merged(rows: DataFrame, length: int) -> DataFrame:
    """Stretches of first windows of shards that are not the first of the corpus."""
    def run(batches):
        held, size = [], 0

        def table(batch_rows):
            doc, first, last, deal, raw = zip(*batch_rows)
            found = merge_rows(np.array(doc, np.int64), np.array(first, np.int64), np.array(last, np.int64) - np.array(first, np.int64) + 1,
                               np.array(deal, np.int64), list(raw), length)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["doc", "first", "last"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                # All rows of a deal are looked at together.
                if size > SHARD and held[-1][3] != row[3]:
                    yield table(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield table(held)

    open_rows = rows.where("deal is not null")
    return map_texts(open_rows.repartition("deal").sortWithinPartitions("deal"), run, "doc long, first long, last long")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Remove each byte that lies in a string of ``length`` bytes which also starts earlier.

    Texts are UTF-8 bytes, ordered by doc_id; matches lie inside a text; strings are judged on the input. Returns
    doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256 (lowercase hex).

    Null and empty texts have no bytes; texts of any length are read whole. Rows that repeat an id and a text are one
    document and each get its result; rows that share an id and differ in their text are ordered by its sha256; a
    null id comes after all others; other columns are ignored; an empty table gives an empty one.

    Every window is compared byte by byte with those it could equal. An anchor however frequent is one row per task
    in the count, its pieces are dealt to shards of bounded size, and its first windows are merged one by one.
    """
    if length < GRAM + 8:
        raise ValueError(f"length must be at least {GRAM + 8}")
    rows, own = places(docs)
    found = materialize(sharded(pieces(rows, suspects(rows, length), length), length), "shards")
    gone = found.where("deal is null").select("doc", "first", "last").unionByName(merged(found, length))
    tag = F.shiftright("first", 31).alias("tag")
    lists = materialize(gone.groupBy("doc", tag).agg(F.collect_list(F.struct("first", "last")).alias("gone")), "gone")
    results = map_texts(squeezed(rows, lists).join(lists, ["doc", "tag"]).select("doc", "tag", "raw", "gone"), cutting(length), (
        "doc long, tag long, n_removed long, n_spans long, sha string")).dropDuplicates(["doc", "tag"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return own.join(results, ["doc", "tag"], "left").select(
        F.when(F.substring("own", 1, 1) == "0", F.col("doc")).cast(kind).alias("doc_id"), "n_bytes",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce(F.col("sha"), F.substring("own", 2, 64)).alias("kept_sha256"))


def cutting(length: int):
    def run(batches):
        for batch in batches:
            out = []
            doc, tag, raw, gone = (batch.column(i).to_pylist() for i in range(4))
            for i, text in enumerate(unpacked(raw)):
                depth = np.zeros(len(text) + 1, np.int64)
                for s in gone[i]:
                    depth[s["first"] - tag[i] * PLACE] += 1
                    depth[s["last"] - tag[i] * PLACE + length] -= 1
                removed = np.cumsum(depth[:-1]) > 0
                kept = np.frombuffer(text, np.uint8)[~removed]
                runs = int(np.count_nonzero(np.diff(np.r_[False, removed].astype(np.int8)) == 1))
                out.append((doc[i], tag[i], int(removed.sum()), runs, hashlib.sha256(kept.tobytes()).hexdigest()))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc", "tag", "n_removed", "n_spans", "sha"])

    return run
