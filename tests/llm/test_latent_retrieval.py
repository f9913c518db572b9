import random

import numpy as np
import pytest
from pyspark.sql import types as T

from millrace.llm import latent_retrieval as r
from millrace.llm.word_bytes import Words

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def lcs(a, b):
    table = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, table[j + 1] = table[j + 1], (last + 1 if x == y else max(table[j + 1], table[j]))
    return table[-1]


def corpus(seed=1):
    rng = random.Random(seed)
    common, rare = ["the", "of", "and", "to", "in"], [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "npqrstvwxz"]

    def prose(n):
        return " ".join(rng.choice(common) if rng.random() < 0.3 else rng.choice(rare) for _ in range(n))

    items = [(i, prose(rng.randint(8, 25)) + ". " + prose(rng.randint(6, 20)) + ".") for i in range(25)]
    docs, leaks = [], set()
    for i in range(250):
        text = prose(rng.randint(0, 150))
        if i % 5 == 0:
            k = i // 5 % 25
            item = items[k][1]
            if i % 10 == 0:  # reworded: case, punctuation and some words
                words = item.split()
                for j in rng.sample(range(len(words)), len(words) // 10):
                    words[j] = "other"
                item = " ,".join(words).upper()
            text = prose(rng.randint(0, 60)) + " " + item + " " + text
            leaks.add((i, k))
        docs.append((i, text))
    return docs, items, leaks


def test_planted_leaks_are_found_and_clean_texts_left_alone(spark, make_docs):
    docs, items, leaks = corpus()
    odd_docs = [(900, None), (901, ""), (902, "the " * 50_000), (903, "x")]
    odd_items = [(90, None), (91, ""), (92, "..."), (None, docs[0][1]), items[0]]
    benchmark = spark.createDataFrame(items + odd_items, ITEMS).selectExpr("*", "1 AS doc_id")
    df = make_docs(docs + odd_docs, ["item_id", "share"])
    found = r.find_leaks(df, benchmark).collect()
    assert {(x["doc_id"], x["item_id"]) for x in found} == leaks and len(found) == len(leaks)
    kept = r.without_leaks(df, benchmark)
    assert kept.columns == df.columns
    assert {x["doc_id"] for x in kept.collect()} == {d for d, _ in docs + odd_docs} - {d for d, _ in leaks}


def test_empty_tables_and_repeated_rows(spark, make_docs):
    docs, items, leaks = corpus(2)
    none = spark.createDataFrame([], ITEMS)
    assert r.find_leaks(make_docs(docs[:5]), none).collect() == [] and r.without_leaks(make_docs(docs[:5]), none).count() == 5
    benchmark = spark.createDataFrame(items, ITEMS)
    assert r.find_leaks(make_docs([]), benchmark).collect() == []
    assert r.find_leaks(make_docs([docs[5]] * 3), benchmark).count() == 3


def test_passes_over_blocks_of_items(spark, make_docs, monkeypatch):
    docs, items, leaks = corpus(3)
    monkeypatch.setattr(r, "ITEMS", 9)
    found = r.find_leaks(make_docs(docs), spark.createDataFrame(items, ITEMS)).collect()
    assert {(x["doc_id"], x["item_id"]) for x in found} == leaks


def test_ordered_share():
    rng = random.Random(4)
    for _ in range(200):
        a = [rng.randrange(5) for _ in range(rng.randint(1, 20))]
        b = [rng.randrange(5) for _ in range(rng.randint(0, 30))]
        assert abs(r.ordered_share(a, b) * len(a) - lcs(a, b)) < 1e-9


def test_words_are_those_of_the_text():
    texts = ["Don't STOP now,  ok?", "", "é.É a-b", "\n\t", "x"]
    raw = [t.encode() for t in texts]
    starts = np.r_[0, np.cumsum([len(x) for x in raw])]
    for marks in (True, False):
        hashes, first, begin, end = Words(marks)(np.frombuffer(b"".join(raw), np.uint8), starts)
        data = b"".join(raw)
        for i, x in enumerate(raw):
            own = [data[b:e].lower() for b, e in zip(begin[first[i]:first[i + 1]], end[first[i]:first[i + 1]])]
            plain = x if marks else bytes(32 if chr(c) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else c for c in x)
            assert own == plain.lower().split()
        alone = {data[b:e].lower(): int(h) for h, b, e in zip(hashes, begin, end)}
        assert len(set(alone.values())) == len(alone)


def test_basis_spans_the_leading_directions(spark):
    """The randomised decomposition agrees with a dense one on a small matrix."""
    rng = np.random.default_rng(6)
    dense = np.zeros((300, r.FEATURES), np.float32)
    dense[:, :80] = rng.normal(size=(300, 12)) @ rng.normal(size=(12, 80)) + 0.01 * rng.normal(size=(300, 80))
    rows = spark.createDataFrame([(list(range(80)), row[:80].tolist()) for row in dense], "terms array<long>, values array<float>")
    basis = r.latent_basis(rows, rank=12)
    _, s, vt = np.linalg.svd(dense[:, :80].astype(float), full_matrices=False)
    scaled = basis[:80].astype(float) * np.linalg.norm(dense[:, :80] @ basis[:80], axis=0)
    assert np.allclose(np.linalg.norm(basis.astype(float), axis=0) * s[:12], 1, rtol=0.02)
    assert np.abs(np.linalg.svd(vt[:12] @ (basis[:80] * s[:12]))[1] - 1).max() < 0.05 and scaled.shape == (80, 12)


def test_products_over_whole_texts_agree_with_dense_passages(spark, make_docs):
    docs, _, _ = corpus(5)
    rng = np.random.default_rng(7)
    rows = r.worded(make_docs(docs + [(900, None), (901, "x"), (902, "the " * 3000)]))
    counts, total = r.passage_counts(rows)
    idf = r.weights(counts, total)
    dense = []
    for row in rows.collect():
        words = np.frombuffer(bytes(row["words"]), "<u2")
        blocks = [words[i:i + r.BLOCK] for i in range(0, len(words), r.BLOCK)]
        for pair in [blocks] if len(blocks) == 1 else [blocks[i:i + 2] for i in range(len(blocks) - 1)]:
            v = np.bincount(np.concatenate(pair), minlength=r.FEATURES) * idf
            dense.append(v / (np.linalg.norm(v) or 1))
    dense = np.array(dense)
    assert total == sum(-(-(len(row["words"]) // 2) // r.BLOCK) for row in rows.collect())
    basis = rng.normal(size=(r.FEATURES, 3)).astype(np.float32)
    assert np.allclose(r.times_transposed(rows, basis, idf), dense.T @ (dense @ basis), atol=1e-3)
    assert np.allclose(r.times_transposed(rows.repartition(5), basis, idf, 2), dense.T @ (dense @ basis), atol=1e-3)


def test_basis_is_fitted_to_every_document(spark, make_docs, monkeypatch):
    """Whatever their number, and with ids that are null or shared."""
    seen = []
    plain = r.latent_basis
    monkeypatch.setattr(r, "latent_basis", lambda rows, *a, **b: seen.append(rows.count()) or plain(rows, *a, **b))
    docs = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"a{i} b{i % 90} c{i % 7}") for i in range(9000)]
    items = spark.createDataFrame([(0, docs[4000][1] + " end.")], ITEMS)
    assert r.find_leaks(make_docs(docs), items).count() > 0 and seen == [9001]


@pytest.mark.parametrize("n", [150, 1200])
def test_recall_of_reworded_items_against_all_stretches(spark, make_docs, n):
    """Items with a share of their words replaced: of those that satisfy the rule somewhere in the text, by a longest common
    subsequence with every stretch, nearly all are found, whatever the number of documents."""
    rng = random.Random(n)
    rare = [f"{a}{b}{c}{d}" for a in "bdfgklm" for b in "aeiou" for c in "npqrstvwxz" for d in "aou"]
    common = ["the", "of", "and", "to", "in"]

    def prose(k):
        return [rng.choice(common) if rng.random() < 0.3 else rng.choice(rare) for _ in range(k)]

    items = [(i, " ".join(prose(30)) + ". " + " ".join(prose(12)) + ".") for i in range(60)]
    docs, planted = [], []
    for i in range(n):
        text = prose(rng.randint(20, 120))
        if i < 120:
            words = items[i % 60][1].split()
            for j in rng.sample(range(len(words)), len(words) * (2 if i < 60 else 3) // 10):
                words[j] = rng.choice(rare) + ("." if words[j].endswith(".") else "")
            at = rng.randint(0, len(text))
            text[at:at] = words
            planted.append((i, i % 60))
        docs.append((i, " ".join(text)))
    inside = set()
    for i, k in planted:
        own, text = items[k][1].replace(".", "").split(), docs[i][1].replace(".", "").split()
        last, size = items[k][1].split(". ")[1].replace(".", "").split(), len(own) * 3 // 2
        # Sure of itself with some room, whatever stretch is looked at: part of the best place decides nothing.
        best = max(lcs(own, text[s:s + size]) for s in range(max(1, len(text) - size + 1))) / len(own)
        if best >= 0.65 and lcs(last, text) / len(last) >= r.ANSWER:
            inside.add((i, k))
    found = {(x["doc_id"], x["item_id"]) for x in r.find_leaks(make_docs(docs), spark.createDataFrame(items, ITEMS)).collect()}
    assert len(inside) >= 60 and len(found & inside) >= 0.9 * len(inside)
    assert found <= set(planted)


def test_blocks_are_added_up_few_at_a_time():
    rng = np.random.default_rng(8)
    values, block = rng.integers(0, 9, (50, 6)).astype(np.float32), rng.integers(0, 50, (3000, r.BLOCK))
    assert (r.block_sums(block, values) == values[block].sum(1)).all() and r.block_sums(block[:0], values).shape == (0, 6)


def test_the_table_that_words_look_up_lies_row_by_row():
    """Singular vectors come column by column, and each word would be gathered from all over the table."""
    basis = np.asfortranarray(np.random.default_rng(1).normal(size=(r.FEATURES, 8)).astype(np.float32))
    table = r.weighted(basis, np.ones(r.FEATURES, np.float32))
    assert table.flags.c_contiguous and table.dtype == np.float32 and (table[:-1] == basis).all() and not table[-1].any()


def test_sums_by_run_are_those_of_reduceat():
    """To the last bit, so that results round as before; most runs are short."""
    rng = np.random.default_rng(12)
    for n, top in ((0, 5), (1, 5), (300, 2), (5000, 1500), (5000, 100_000)):
        terms = np.sort((top * rng.random(n) ** 3).astype(np.int64))
        rows, column = rng.integers(0, 400, n), rng.normal(size=(400, 2)).astype(np.float32).view(np.complex64).ravel()
        if not n:
            continue
        heads = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]])
        found, order, add = r.sums_by_run(terms, rows)
        at = np.argsort(found)
        assert (found[at] == terms[heads]).all()
        assert (add(column.take(order))[at] == np.add.reduceat(column.take(rows), heads)).all()
