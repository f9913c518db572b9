"""Source divergence audit: how far each source of a language is from its other sources, and by which terms.

The divergence of a source from a peer is a sum over all kept terms of their language. Terms that neither has, or only
one of them, give values that depend on the totals and one count alone. So a source's row starts from these zero baselines,
and its own terms are then scattered through the term-major index into one accumulator over its peers, which turns the
baseline of every term that both have into the exact value. Pairs of postings are never emitted.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.blocks import whole_cells
from millrace.llm.common import bytes_of, map_texts, materialize

# Bytes that are no part of a term, the scale of shares, the least documents, the ranks of part term.
NO_TERM = bytes([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
SCALE = 1_000_000_000
LEAST_DOCS = 3
TERM_RANKS = 200

SPREAD = bytes.maketrans(NO_TERM + bytes(range(0x41, 0x5B)), b" " * len(NO_TERM) + bytes(range(0x61, 0x7B)))
TALLY = 200_000   # terms that a task gathers before it gives them on
PIECE = 1 << 22   # bytes of a long text that are split at a time
CELL = 400_000    # postings of a block of terms
ROWS = 2_048      # sources that scatter their terms through a block in one task
STEP = 1 << 20    # values computed at a time


def words_of(text: bytes):
    """Lists of the terms of a text, a long one piece by piece."""
    start = 0
    while start < len(text):
        stop = min(len(text), start + PIECE)
        part = text[start:stop].translate(SPREAD)
        if stop < len(text):
            cut = part.rfind(b" ")
            while cut < 0 and stop < len(text):  # a term that is longer than a piece
                more = text[stop:stop + PIECE].translate(SPREAD)
                stop += len(more)
                at = more.find(b" ")
                cut = len(part) + at if at >= 0 else -1
                part += more
            part = part if cut < 0 else part[:cut]
        yield part.split()
        start += max(len(part), 1)


def tallies(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group, added up; and a row with
    the empty term and zeros for every group, whether it has terms or not."""
    def run(batches):
        times: dict[tuple, Counter] = {}
        inside: dict[tuple, Counter] = {}

        def drain():
            for group, found in times.items():
                terms = list(found)
                for a in range(0, len(terms) + 1, 50_000):
                    some = terms[a:a + 50_000] + ([b""] if a + 50_000 > len(terms) else [])
                    yield pa.RecordBatch.from_arrays([
                        pa.array([group[0]] * len(some)), pa.array([group[1]] * len(some)),
                        pa.array(some, pa.binary()).cast(pa.string()), pa.array([found[t] for t in some], pa.int64()),
                        pa.array([inside[group][t] for t in some], pa.int64())], ["lang", "source", "term", "n", "docs"])
            times.clear()
            inside.clear()

        for batch in batches:
            data, starts = bytes_of(batch.column(2))
            for i, group in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                count, here = times.setdefault(group, Counter()), inside.setdefault(group, Counter())
                seen: set[bytes] = set()
                for words in words_of(data[starts[i]:starts[i + 1]].tobytes()):
                    count.update(words)
                    seen.update(words)
                here.update(seen)
            if sum(map(len, times.values())) >= TALLY:
                yield from drain()
        yield from drain()

    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    found = map_texts(rows, run, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), exact."""
    above = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(19,0)")
    return F.lit(1).cast("long") + F.call_function("div", above, F.greatest(total + terms, F.lit(1)).cast("decimal(19,0)"))


def gap(p, q):
    """floor((p - q)^2 / q), for columns of a numpy array."""
    return (p - q) * (p - q) // q


def kept_postings(tallied: DataFrame, least_docs: int) -> DataFrame:
    """Rows of the terms in at least ``least_docs`` documents of their language, with the language's count; ``first`` marks
    one row of each term."""
    term = Window.partitionBy("lang", "term")
    return tallied.where("term <> ''").select(
        "lang", "source", "term", "n", F.sum("n").over(term).alias("lang_n"), F.sum("docs").over(term).alias("in_docs"),
        (F.col("source") == F.min("source").over(term)).cast("long").alias("first")).where(
        F.col("in_docs") >= least_docs).drop("in_docs")


def group_totals(tallied: DataFrame, postings: DataFrame, cell: int, rows: int) -> DataFrame:
    """One row per group: its total, its language's total and number of terms, its share of a term that it lacks, and
    into how many blocks of terms and chunks of groups the language is cut."""
    groups = tallied.where("term = ''").select("lang", "source")
    own = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    whole = postings.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum("first").alias("terms"), F.count("*").alias("entries"))
    sizes = groups.groupBy("lang").agg(F.ceil(F.count("*") / rows).cast("int").alias("chunks"))
    joined = groups.join(own, ["lang", "source"], "left").join(sizes, "lang").join(whole, "lang", "left").na.fill(
        0, ["total", "lang_total", "terms", "entries"])
    return joined.select("lang", "source", "total", "lang_total", "terms", "chunks",
                         F.greatest(F.ceil(F.col("entries") / cell), F.lit(1)).cast("int").alias("blocks"),
                         share(F.lit(0), F.col("total"), F.col("terms")).alias("p0"))


def numbers(column) -> tuple[np.ndarray, pa.Array]:
    coded = pc.dictionary_encode(column).combine_chunks()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def accumulate(group: np.ndarray, own: np.ndarray, p0: np.ndarray, term: np.ndarray, source: np.ndarray, p: np.ndarray):
    """(group, values over all groups) for each group marked ``own``: its gap to each peer over a block of terms.

    p0 is the share of a missing term by group; ``term``, ``source`` and ``p`` are the postings of the block.
    """
    terms = int(term.max()) + 1 if len(term) else 0
    by_term = np.argsort(term, kind="stable")
    ends = np.cumsum(np.bincount(term, minlength=terms)) if terms else np.zeros(0, np.int64)
    begins = np.r_[0, ends[:-1]] if terms else ends
    peers, q = source[by_term], p[by_term]
    by_group = np.argsort(source, kind="stable")
    reach = np.searchsorted(source[by_group], np.arange(len(p0) + 1))
    # Peers' shares with how often each occurs: what a row without the terms meets.
    order = np.lexsort((p, source))
    new = np.ones(len(order), bool)
    new[1:] = (source[order][1:] != source[order][:-1]) | (p[order][1:] != p[order][:-1])
    at = np.flatnonzero(new)
    seen_by, seen, often = source[order][at], p[order][at], np.diff(np.r_[at, len(order)])
    for a in group[own].tolist():
        base = gap(p0[a], p0)
        row = terms * base
        np.add.at(row, seen_by, (gap(p0[a], seen) - base[seen_by]) * often)
        mine = by_group[reach[a]:reach[a + 1]]
        values, times = np.unique(p[mine], return_counts=True)
        width = max(1, STEP // len(p0))
        for i in range(0, len(values), width):
            row += ((gap(values[i:i + width, None], p0[None, :]) - base) * times[i:i + width, None]).sum(0)
        # Terms that both have: both baselines go, the true value comes.
        size = ends[term[mine]] - begins[term[mine]]
        cuts = np.searchsorted(np.cumsum(size), np.arange(STEP, size.sum() + STEP, STEP)) + 1 if len(mine) else []
        first = 0
        for last in np.unique(np.minimum(cuts, len(mine))).astype(int).tolist():
            some, length = mine[first:last], size[first:last]
            place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(begins[term[some]], length)
            x, peer, y = np.repeat(p[some], length), peers[place], q[place]
            np.add.at(row, peer, gap(x, y) - gap(x, p0[peer]) - gap(p0[a], y) + base[peer])
            first = last
        yield a, row


def pair_gaps(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for all pairs of groups of a language: the gap summed over its terms.

    A cell is a block of a language's terms and a chunk of its groups. It holds the index of the block and the list of
    all groups, and gives each of its groups' accumulator on; those of different blocks are added up.
    """
    info = groups.select("lang", "source", "total", "terms", "p0", "blocks", "chunks")
    rows = postings.join(info, ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "chunks", "source", "term",
        share(F.col("n"), F.col("total"), F.col("terms")).alias("p"))
    lists = info.select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "chunks", "source",
                        F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"))
    home = F.pmod(F.xxhash64("source"), F.col("chunks")).cast("int")
    cells = rows.unionByName(lists).select(
        "lang", "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), home.alias("home"),
        "source", "term", "p")

    def run(batches):
        for cell in whole_cells(batches, 3):
            source, names = numbers(cell["source"])
            term, _ = numbers(cell["term"])
            p = cell["p"].to_numpy()
            own = cell["home"].to_numpy() == cell["chunk"].to_numpy()
            listed = cell["term"].is_null().to_numpy()
            p0 = np.ones(len(names), np.int64)
            p0[source[listed]] = p[listed]
            lang = cell["lang"][0].as_py()
            of_term = term[~listed].astype(np.int64)
            for a, row in accumulate(source[listed].astype(np.int64), own[listed], p0, of_term, source[~listed].astype(np.int64), p[~listed]):
                for i in range(0, len(row), STEP):
                    others = np.arange(i, min(len(row), i + STEP))
                    others = others[others != a]
                    if len(others):
                        yield pa.RecordBatch.from_arrays([
                            pa.array([lang] * len(others), pa.string()), pa.repeat(names[a], len(others)).cast(pa.string()),
                            names.take(pa.array(others)).cast(pa.string()), pa.array(row[others])],
                            ["lang", "source", "item", "value"])

    found = cells.repartition("lang", "block", "chunk").sortWithinPartitions("lang", "block", "chunk").mapInArrow(
        run, "lang string, source string, item string, value long")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_gaps(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for the terms that a group has more of than its language."""
    info = groups.select("lang", "source", "total", "lang_total", "terms")
    shares = postings.join(info, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q")).where("p > q")
    return shares.select("lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = TERM_RANKS, cell: int = CELL, rows: int = ROWS) -> DataFrame:
    """Compare the term shares of each source with those of its language's other sources and of the language.

    Returns lang, source, part, item, value, rank. Part ``pair``: each other source of the language with the gap summed
    over all kept terms. Part ``term``: the ``ranks`` terms of the largest gap to the language among those that the
    source has more of. Rank 1 has the largest value, ties go by item. All figures are exact integers.

    Null text, lang and source are read as the empty text; a group whose texts are empty still takes part; a language
    without kept terms gives pairs of value 0; texts of any length are read whole; each repeated row is a document;
    other columns are ignored; an empty table gives an empty one.

    ``cell`` (postings in a block of terms) and ``rows`` (groups in a chunk) bound a task's memory and change no result.
    """
    tallied = materialize(tallies(docs), "tallies")
    postings = materialize(kept_postings(tallied, least_docs), "postings")
    groups = materialize(group_totals(tallied, postings, cell, rows), "groups")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_gaps(postings, groups).withColumn("rank", F.row_number().over(order))
    terms = term_gaps(postings, groups).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    columns = ("item", "value", "rank")
    return pairs.select("lang", "source", F.lit("pair").alias("part"), *columns).unionByName(
        terms.select("lang", "source", F.lit("term").alias("part"), *columns))


#: The same in SQL, over the table documents.
SQL = r"""WITH docs AS (SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
tokens AS (SELECT row_id, lang, source, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS lang_n FROM tokens GROUP BY lang, term HAVING count(DISTINCT row_id) >= 3),
counts AS (SELECT t.lang, t.source, t.term, count(*)::HUGEINT AS n FROM tokens t JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS total FROM groups g
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
shares AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
  1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (t.total + l.v) AS p, 1 + (1000000000 * (k.lang_n + 1)) // (l.total + l.v) AS q
  FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value FROM groups a
  JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value,
  row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value,
  row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked
WHERE part = 'pair' OR rank <= 200"""
