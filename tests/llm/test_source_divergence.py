import random
import re
from collections import Counter, defaultdict

import duckdb

from millrace.llm import source_divergence as D


def brute(rows, least=3, ranks=200):
    """Part by part in plain Python: rows of (lang, source, text)."""
    counts, inside = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = [t.translate({c: c + 32 for c in range(65, 91)}) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts[lang, source].update(terms)
        inside[lang].update(set(terms))
    out = []
    for lang in {lang for lang, _ in counts}:
        groups = {s: c for (g, s), c in counts.items() if g == lang}
        kept = [t for t, n in inside[lang].items() if n >= least]
        whole = Counter()
        for c in groups.values():
            whole.update(c)

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        share = {s: shares(c) for s, c in groups.items()}
        q = shares(whole)

        def gap(x, y):
            return (x - y) ** 2 // y

        for s, c in groups.items():
            pairs = [(o, sum(gap(share[s][t], share[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, gap(share[s][t], q[t])) for t in kept if c[t] and share[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, ranks)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:most])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "lang string, source string, text string, term string")


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def sample(rng, n):
    words = ["alpha", "Beta", "été", "ÉTÉ", "z", "ß", "naïve", "x1y", "日本", "_under_", "don't"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)]
    rows = []
    for _ in range(n):
        text = rng.choice([" ", "\t", "-", "\x00", "…"]).join(rng.choice(words) for _ in range(rng.randint(0, 25)))
        rows.append((rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "c", "é", None]), rng.choice([text, text.upper(), None])))
    # A hot group, a group without terms, a language without kept terms.
    rows += [("en", "a", "the alpha the beta")] * (n // 3) + [("en", "bare", "12 34")] + [("xx", "p", "lone"), ("xx", "q", None), ("yy", "only", "a a a")]
    return rows


def test_equals_brute_force(spark):
    rng = random.Random(4)
    rows = sample(rng, 150)
    expected = brute(rows)
    assert found(D.audit(frame(spark, rows))) == expected
    # Many blocks and chunks, a step of a few values, tallies given on early: the same rows.
    step, tally, piece = D.STEP, D.TALLY, D.PIECE
    try:
        D.STEP, D.TALLY, D.PIECE = 7, 20, 5
        assert found(D.audit(frame(spark, rows).repartition(5), cell=9, rows=2)) == expected
    finally:
        D.STEP, D.TALLY, D.PIECE = step, tally, piece


def test_sql_agrees(spark):
    rows = sample(random.Random(9), 80)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (lang VARCHAR, source VARCHAR, text VARCHAR)")
    rows = [(a, b, c.replace("\x00", " ") if c else c) for a, b, c in rows]
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    columns = "lang, source, part, item, value, rank"
    assert sorted(con.execute(f"SELECT {columns} FROM ({D.SQL})").fetchall()) == found(D.audit(frame(spark, rows)))


def test_ranks_and_ties(spark):
    # 300 terms of one source only, all with the same count: ties go by item, 200 ranks stay.
    words = [f"t{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    rows = [("en", "a", " ".join(words))] * 3 + [("en", "b", "other words here")] * 3
    got = [r for r in found(D.audit(frame(spark, rows))) if r[1] == "a" and r[2] == "term"]
    assert [r[3] for r in sorted(got, key=lambda r: r[5])] == sorted(words)[:200] and got == [r for r in brute(rows) if r[1:3] == ("a", "term")]


def test_words_of_pieces():
    text = b"Aa bb" * 50 + b" " + b"x" * 100 + b"  c \xc3\xa9d1e"
    whole = text.translate(D.SPREAD).split()
    piece = D.PIECE
    try:
        for D.PIECE in (1, 3, 7, 64, 1000):
            assert [w for part in D.words_of(text) for w in part] == whole
    finally:
        D.PIECE = piece


def test_large_counts_are_exact(spark):
    # Shares are divided in decimals: counts beyond what a long times the scale can hold.
    big = spark.createDataFrame([(10**12 + 7, 3 * 10**12 + 11, 12345)], "n long, total long, terms long")
    assert big.select(D.share(big.n, big.total, big.terms)).first()[0] == 1 + 10**9 * (10**12 + 8) // (3 * 10**12 + 11 + 12345)


def test_empty(spark):
    assert found(D.audit(frame(spark, []))) == []
    assert found(D.audit(frame(spark, [(None, None, None)]))) == []
