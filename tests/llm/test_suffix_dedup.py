import hashlib
import random

import numpy as np
import pytest

from millrace.llm import suffix_dedup as s
from millrace.llm.suffix_array import common_prefixes, repeated, suffix_order, words_at


def brute(docs, length=100):
    """Result by id for documents in order."""
    seen, out = set(), {}
    for i, text in docs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - length + 1):
            window = raw[k:k + length]
            if window in seen:
                gone[k:k + length] = True
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(g and (not k or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def found(df, length=100):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in s.remove_repeats(df, length).collect()}


def corpus(seed):
    rng = random.Random(seed)
    words = ["alpha", "béta", "g", "delta\n", "epsilon", "ζ", "eta"] + [f"w{i}" for i in range(60)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    line = "This very line stands in many texts but is shorter than the bound."
    passage = prose(60)
    docs = []
    for i in range(120):
        kind = rng.randrange(8)
        text = prose(rng.randint(0, 120))
        if kind == 0 and docs:
            text = rng.choice(docs)[1]
        elif kind == 1 and docs:
            old = rng.choice(docs)[1]
            cut = rng.randint(0, len(old))
            text = old[:cut] + "X" + old[cut:]
        elif kind == 2:
            text = prose(9) + passage + prose(9)
        elif kind == 3:
            text += line + prose(12) + line
        elif kind == 4:
            text = rng.choice(["ab", "x", "abc def "]) * rng.randint(1, 200)
        elif kind == 5:
            text += "\0" * rng.randint(90, 130)
        docs.append((i * 7 + 2, text))
    return docs


@pytest.mark.parametrize("seed, shard, hot, deal", [(1, 1 << 21, 2000, 4096), (2, 3000, 3, 2)])
def test_against_brute_force(make_docs, monkeypatch, seed, shard, hot, deal):
    """Also with tiny shards, where nearly everything is merged across them, and with every anchor hot."""
    for name, value in (("SHARD", shard), ("HOT", hot), ("DEAL", deal), ("MEMORY", 100)):
        monkeypatch.setattr(s, name, value)
    docs = corpus(seed)
    shuffled = docs[:]
    random.Random(9).shuffle(shuffled)
    df = make_docs(shuffled, ["raw", "doc", "tag", "place"]).repartition(5)
    assert found(df) == brute(docs)


def test_odd_rows(make_docs):
    rng = random.Random(6)
    long = "".join(rng.choice("abcdefgh é\n") for _ in range(150_000))
    docs = [(1, None), (2, ""), (3, long), (4, long[50_000:50_100]), (5, "y" * 99), (6, "y" * 99), (7, "y" * 100), (8, long)]
    assert found(make_docs(docs)) == brute(docs)
    assert s.remove_repeats(make_docs([])).collect() == []
    # Repeated rows are one document; a null id comes last.
    rows = s.remove_repeats(make_docs([(5, "q" * 60 + "r" * 90)] * 3 + [(None, "q" * 60 + "r" * 90), (9, "s")])).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in rows) == [(0, 150), (5, 0), (5, 0), (5, 0), (9, 0)]
    # Of two texts of one id, one is before the other.
    rows = s.remove_repeats(make_docs([(5, "k" + long[:200]), (5, long[:200])])).collect()
    assert sorted(r["n_removed"] for r in rows) == [0, len(long[:200].encode())]


def test_suffix_order_and_prefixes():
    rng = np.random.default_rng(3)
    for size, letters in ((0, 2), (1, 2), (300, 2), (500, 4), (400, 1)):
        text = rng.integers(97, 97 + letters, size).astype(np.uint8)
        words = words_at(text, 300)
        order, _ = suffix_order(words, size, 128)
        raw = text.tobytes().ljust(size + 300, b"\0")
        keys = [raw[i:i + 128] for i in order]
        assert sorted(order.tolist()) == list(range(size)) and keys == sorted(keys)
        shared = common_prefixes(words, order, np.ones(size, bool), 100)
        for j in range(1, size):
            a, b = raw[order[j - 1]:order[j - 1] + 100], raw[order[j]:order[j] + 100]
            assert shared[j] == next((k for k in range(100) if a[k] != b[k]), 100)
        first = repeated(text, 100)
        seen = {}
        assert first.tolist() == [seen.setdefault(raw[i:i + 100], i) for i in range(size)]


def test_hash_clashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(s.Anchors, "hashes", lambda self, data, size: np.zeros(len(data) - size + 1, np.uint64))
    texts = [b"a" * 100, b"b" * 100, b"a" * 100, b"b" * 100]
    doc, first, last = s.merge_rows(np.arange(4), np.zeros(4, np.int64), np.ones(4, np.int64), np.zeros(4, np.int64), texts, 100)
    assert doc.tolist() == [2, 3] and first.tolist() == last.tolist() == [0, 0]


def test_many_texts_of_one_id(make_docs):
    rng = random.Random(12)
    prose = ["".join(rng.choice("abcdefgh ") for _ in range(150)) for _ in range(30)]
    rows = [(None, t) for t in prose] + [(5, t[:120] + str(i)) for i, t in enumerate(prose)] + [(None, prose[0] + "tail"), (5, "short")]
    ordered = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(r[1].encode()).hexdigest()))
    expected = brute([((d, t), t) for d, t in ordered])
    got = s.remove_repeats(make_docs(rows)).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == sorted(
        (d or 0, *v) for (d, _), v in expected.items())


def test_texts_of_one_id_whose_short_hashes_agree(spark, make_docs):
    """Null-id texts that agree in 22 bits of their hash and share a passage."""
    from pyspark.sql import functions as F
    rng = random.Random(13)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(130))
    near = spark.range(8000).select(F.concat(F.col("id").cast("string"), F.lit(passage), F.repeat(F.lit("y"), (F.col("id") % 9).cast("int"))).alias("t"))
    twins = near.groupBy(F.xxhash64("t").bitwiseAND((1 << 22) - 1).alias("k")).agg(F.collect_list("t").alias("ts")).where("size(ts) > 1").collect()
    texts = sorted((t for r in twins for t in r["ts"]), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert texts
    got = s.remove_repeats(make_docs([(None, t) for t in texts])).collect()
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == sorted(brute([(t, t) for t in texts]).values())


def test_a_repeated_row_that_shares_a_passage(make_docs):
    """The repeats of a row know their anchors by other counts than its first one."""
    docs = corpus(4)
    rows = [d for i, d in enumerate(docs) for _ in range(1 + 3 * (i % 4 == 0))]
    random.Random(3).shuffle(rows)
    expected = brute(docs)
    for parts in (1, 4):
        got = s.remove_repeats(make_docs(rows).repartition(parts)).collect()
        assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == sorted(
            (i, *expected[i]) for i, _ in rows)


def test_the_largest_id_and_null_ids_are_apart(spark, make_docs):
    rng = random.Random(21)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(150))
    top = (1 << 63) - 1
    docs = [(top, passage + "one"), (None, passage + "two"), (None, passage + "two"), (3, "short")]
    found = sorted(((r["doc_id"], r["n_removed"]) for r in s.remove_repeats(make_docs(docs)).collect()), key=str)
    assert found == sorted([(top, 0), (None, 150), (None, 150), (3, 0)], key=str)
    alone = s.remove_repeats(make_docs([(top, passage), (4, passage)])).collect()
    assert {(r["doc_id"], r["n_removed"]) for r in alone} == {(4, 0), (top, 150)}
    same = s.remove_repeats(make_docs([(None, passage), (top, passage)])).collect()
    assert {(r["doc_id"], r["n_removed"]) for r in same} == {(top, 0), (None, 150)}
