"""Main text of web pages by differencing each page with its nearest pages by URL.

Pages of a host are put in order of their URL path. Each is paired with the nearest pages before and after it that share
one of its lines, and aligned with them by a longest common subsequence; lines that it shares are template and deleted.
Lines in an element that names the article are spared: pages of a host also share lines of their texts. Of the lines that
no other page has, those in elements named as menus, adverts, comments and the like are dropped.
"""

from __future__ import annotations

from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import map_texts, materialize, strings
from millrace.llm.html_blocks import blocks_of

COPY = 0.5      # share of the lines that few pages have above which a page that has them too is a copy
MAIN, OTHER, NAMED = "1", "0", "2"   # kinds of lines
LINK, FIRST, LAST = 0, 1, 2           # kinds of rows of a task that links lines
EVERY = 128     # rows of the alignment between two that are kept


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``.

    Bit-parallel: one big number per row of the table; every EVERY-th is kept and those between are made
    again on the way back, so long pages need little memory.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    out = list(range(head))
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    where: dict[int, int] = {}
    for j, line in enumerate(y):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << len(y)) - 1

    def after(v: int, line: int) -> int:
        u = v & where.get(line, 0)
        return ((v + u) | (v - u)) & full

    kept, v = [full], full
    for i, line in enumerate(x):
        v = after(v, line)
        if (i + 1) % EVERY == 0:
            kept.append(v)
    found, j = [], len(y)
    for part in range(len(x) // EVERY, -1, -1):
        first, last = part * EVERY, min((part + 1) * EVERY, len(x))
        rows = [kept[part]]
        for i in range(first, last):
            rows.append(after(rows[-1], x[i]))
        i = last
        while i > first and j:
            # A zero bit of row i says that the length grows at that column.
            if rows[i - first] >> (j - 1) & 1:
                j -= 1
            elif not rows[i - 1 - first] >> (j - 1) & 1:
                i -= 1
            else:
                found.append(head + i - 1)
                i, j = i - 1, j - 1
    out += reversed(found)
    return out + list(range(len(a) - tail, len(a)))


def place(url: str) -> tuple[str, str]:
    """Host and path of a URL, both empty where there is none."""
    try:
        parts = urlsplit(url)
        return (parts.hostname or ""), parts.path
    except ValueError:
        return "", url


def read_page(url: str, page: str):
    """Host, path, blocks with their kind (MAIN in an article, NAMED in a part named otherwise, OTHER), and a hash of host and
    blocks."""
    host, path = place(url)
    lines = [(MAIN if m else NAMED if n else OTHER) + b for b, m, n in zip(*blocks_of(page))]
    entry = xxhash.xxh64_intdigest("\n".join([host, *lines]).encode("utf-8", "surrogatepass")) - (1 << 63)
    return host, path, lines, entry


def entries_of(pages: DataFrame) -> DataFrame:
    """Different pages of a host with lines outside an article: entry, host, least path, whether there is no article (bare),
    and hashes of these lines (open).
    Pages that are equal line by line are one entry, so that copies say nothing about templates."""
    def run(batches):
        for batch in batches:
            found = []
            for url, page in zip(strings(batch.column(0)), strings(batch.column(1))):
                host, path, lines, entry = read_page(url, page)
                open_lines = [xxhash.xxh64_intdigest(b[1:].encode("utf-8", "surrogatepass")) - (1 << 63) for b in lines if b[0] != MAIN]
                if open_lines:
                    found.append((entry, host, path, len(open_lines) == len(lines), open_lines))
            columns = list(zip(*found)) or [()] * 5
            kinds = [pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["entry", "host", "path", "bare", "open"])

    found = map_texts(pages.select("url", "html"), run, "entry long, host string, path string, bare boolean, open array<long>")
    return found.groupBy("entry").agg(F.min("host").alias("host"), F.min("path").alias("path"), F.first("bare").alias("bare"),
                                      F.first("open").alias("open"))


def bodies(pages: DataFrame) -> DataFrame:
    """page_id, url, entry and body of each page: its lines with their kinds, packed, without the text of named parts."""
    def run(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            found = []
            for url, page in zip(strings(batch.column(1)), strings(batch.column(2))):
                _, _, lines, entry = read_page(url, page)
                body = "\n".join(NAMED if b[0] == NAMED else b for b in lines)
                found.append((entry, packer.compress(body.encode("utf-8", "surrogatepass"))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.binary())],
                ["page_id", "url", "entry", "body"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_texts(pages.select("page_id", "url", "html"), run, f"page_id {kind}, url string, entry long, body binary")


def neighbours(entries: DataFrame) -> DataFrame:
    """(entry, line, other): for each line of an entry the entries before and after it, by path, that have the line.

    Rows are range partitioned by line (and host) and path and sorted, so a line or host of any size is spread over tasks.
    Each task links its rows as they come, and hands on its first and its last row, which are linked with those of the
    tasks beside it.
    """
    order = ["line", "path", "entry"]
    line = F.xxhash64("host", "line").alias("line")
    keys = entries.select("host", F.explode(F.array_distinct("open")).alias("line"), "path", "entry").select(line, "path", "entry")
    sorted_keys = keys.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "line", "entry", F.spark_partition_id().alias("deal"))

    def run(batches):
        last, deal = None, 0
        names = ["deal", "kind", "line", "entry", "other"]

        def rows(kind, lines, own, others):
            n = len(lines)
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, deal, np.int32)), pa.array(np.full(n, kind, np.int32)),
                                               pa.array(lines), pa.array(own), pa.array(others)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            lines, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            deal = batch.column(2)[0].as_py()
            if last is None:
                yield rows(FIRST, lines[:1], own[:1], own[:1])
                last = lines[:0], own[:0]
            lines, own = np.r_[last[0], lines], np.r_[last[1], own]
            same = np.flatnonzero(lines[1:] == lines[:-1])
            yield rows(LINK, lines[same], own[same + 1], own[same])
            last = lines[-1:], own[-1:]
        if last is not None:
            yield rows(LAST, *last, last[1])

    found = materialize(sorted_keys.mapInArrow(run, "deal int, kind int, line long, entry long, other long"), "links")
    inner = found.where(F.col("kind") == LINK).select("entry", "line", "other")
    ends = found.where(F.col("kind") != LINK).groupBy("deal").agg(
        *[F.max(F.when(F.col("kind") == kind, F.struct("line", "entry"))).alias(name) for kind, name in ((FIRST, "first"), (LAST, "last"))])
    outer = ends.select("first", F.lag("last").over(Window.orderBy("deal")).alias("last")).where("first.line = last.line").select(
        F.col("first.entry").alias("entry"), F.col("first.line").alias("line"), F.col("last.entry").alias("other"))
    forward = inner.unionByName(outer)
    return forward.unionByName(forward.select(F.col("other").alias("entry"), "line", F.col("entry").alias("other")))


def shared_lines(mine: list[int], bare: bool, many: set[int], others: list[tuple[list[int], set[int]]]) -> list[int]:
    """Positions of the lines that a page shares with the other pages by alignment.

    ``many`` has the lines with a page on either side, and ``others`` the lines of each other page, and its own ``many``: a
    line in either is on three pages at least. On a bare page, if the lines that two pages alone have are most of what
    the page does not share with more, the other page is a copy of it, and they are left.
    """
    shared: set[int] = set()
    for lines, theirs in others:
        same = common_lines(mine, lines)
        wide = many | theirs
        few = [i for i in same if mine[i] not in wide]
        rare = sum(line not in wide for line in mine)
        shared.update(i for i in same if mine[i] in wide)
        if not bare or len(few) <= COPY * rare:
            shared.update(few)
    return sorted(shared)


def differences(entries: DataFrame) -> DataFrame:
    """(entry, shared): the positions, among its open lines, of those that an entry shares with its nearest entries."""
    # Dealt by entry once, for both aggregates.
    by_line = neighbours(entries).repartition("entry").groupBy("entry", "line").agg(
        (F.count("*") == 2).alias("many"), F.collect_set("other").alias("others"))
    by_entry = materialize(by_line.groupBy("entry").agg(
        F.collect_list(F.when(F.col("many"), F.col("line"))).alias("many"),
        F.array_distinct(F.flatten(F.collect_list("others"))).alias("others")).join(
        entries.select("entry", "bare", F.transform("open", lambda x: F.xxhash64("host", x)).alias("open")), "entry"), "linked")
    lists = by_entry.select(F.col("entry").alias("other"), F.struct("open", "many").alias("lines"))
    near = by_entry.select("entry", F.explode("others").alias("other")).join(lists, "other").groupBy("entry").agg(
        F.collect_list("lines").alias("near"))

    def run(batches):
        for batch in batches:
            page = batch.to_pydict()
            found = [shared_lines(mine, bare, set(many), sorted(((o["open"], set(o["many"])) for o in near), key=lambda o: (o[0], sorted(o[1]))))
                     for mine, bare, many, near in zip(page["open"], page["bare"], page["many"], page["near"])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], ["entry", "shared"])

    return map_texts(by_entry.select("entry", "open", "bare", "many").join(near, "entry"), run, "entry long, shared array<int>")


def kept_lines(body: str, shared: list[int]) -> tuple[list[str], int, int]:
    """The lines that stay, and how many go because other pages share them, and because of the element they are in."""
    gone, kept, by_name, place = set(shared), [], 0, 0
    for line in body.split("\n") if body else ():
        kind = line[0]
        if kind != MAIN:
            place += 1
            if place - 1 in gone:
                continue
            if kind == NAMED:
                by_name += 1
                continue
        kept.append(line[1:])
    return kept, len(gone), by_name


def extract(pages: DataFrame) -> DataFrame:
    """Main text of every page.

    Returns page_id, url, text, n_chars (code points), n_shared and n_named (lines deleted by differencing, and by the name
    of their element). Scripts, styles and the like have no lines. Each line outside an ``article`` (or else ``main``)
    element is deleted that the page shares, by longest common subsequence, with one of the pages nearest to it in the URL
    order of its host that have one of its lines. Of the other lines outside, those in elements named by tag, role, class
    or id as menus, headers, footers, side bars, notices, adverts, forms or comments go. Pages that are equal line by line
    count as one; a page that shares most of what no third page has is a copy and says nothing about templates.

    A null or empty html has text '' and length 0; pages of any length are read whole; null or broken URLs
    count as host ''; repeated rows each get their row; other columns are ignored; an empty table gives an
    empty one.
    """
    shared = differences(materialize(entries_of(pages), "entries"))
    # Pages are parsed again rather than stored: their texts move once, to meet what is deleted.
    every = bodies(pages).join(shared, "entry", "left")

    def run(batches):
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            found = [kept_lines(unpacker.decompress(body).decode("utf-8", "surrogatepass"), gone or [])
                     for body, gone in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            texts = [" ".join(f[0]) for f in found]
            counts = [np.array([len(t) for t in texts], np.int64), *(np.array([f[i] for f in found], np.int64) for i in (1, 2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), *map(pa.array, counts)],
                ["page_id", "url", "text", "n_chars", "n_shared", "n_named"])

    return map_texts(every.select("page_id", "url", "body", "shared"), run, (
        f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long, n_shared long, n_named long"))
