import numpy as np
import pytest

from millrace.llm import pivot_index as p


def brute(ids, vectors):
    x = np.array(vectors, float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= 0.95
    np.fill_diagonal(linked, False)
    label = np.array(ids)
    while True:
        new = np.array([min([label[i], *label[linked[i]]]) for i in range(len(ids))])
        if (new == label).all():
            return linked.sum(1), label
        label = new


def clouds(seed, size=24):
    """Groups of near copies, one of them with a third of all rows, and cosines on both sides of the bound."""
    rng = np.random.default_rng(seed)
    rows = []
    for n in [130] + [1] * 60 + [2] * 30 + [7] * 12:
        centre = rng.normal(size=size)
        for k in range(n):
            rows.append(centre + rng.normal(size=size) * rng.choice([0.02, 0.1, 0.25]) * (k > 0))
    order = rng.permutation(len(rows))
    return [int(i) * 5 + 3 for i in order], [rows[i].astype(np.float32).tolist() for i in order]


@pytest.mark.parametrize("block", [1024, 16])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(p.verified, "__defaults__", (block,))
    monkeypatch.setattr(p, "SMALL", 50)
    ids, vectors = clouds(block)
    df = spark.createDataFrame(list(zip(ids, vectors, [1] * len(ids))), "vec_id long, embedding array<float>, label int")
    found = {r["vec_id"]: r for r in p.near_duplicates(df.selectExpr("*", "'x' AS key", "2 AS side")).collect()}
    counts, label = brute(ids, vectors)
    recall = sum(found[i]["n_links"] for i in ids) / counts.sum()
    assert recall >= 0.99
    if recall == 1:
        assert [found[i]["n_links"] for i in ids] == counts.tolist()
        assert [found[i]["component_id"] for i in ids] == label.tolist()
    assert all(found[i]["kept"] == (found[i]["component_id"] == i) and found[i]["n_links"] <= c for i, c in zip(ids, counts))


def links(spark, rows, **options):
    df = spark.createDataFrame([(a, b, 0) for a, b in rows], "vec_id long, embedding array<float>, label int")
    return sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in p.near_duplicates(df, **options).collect()), key=str)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, -0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, -0.0]), (10, [1e30, 1e28]), (11, [-1.0, 0.0]), (None, None)]
    assert links(spark, rows) == sorted([
        (1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (10, 3, 1, False), (None, 3, 1, False), (None, 0, None, False),
        *[(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 11)]], key=str)
    assert links(spark, []) == [] and links(spark, [(5, [0.0])]) == [(5, 0, 5, True)]


def test_every_row_and_every_length(spark):
    # Null ids with different vectors, an id with two vectors, a length that few have.
    rows = [(None, [1.0, 0.0]), (None, [0.0, 1.0]), (5, [1.0, 0.1]), (5, [0.0, 1.0]), (6, [-1.0, 0.0]), (7, [-1.0, 0.01]),
            (8, [1.0, 2.0, 3.0]), (9, [1.0, 2.0, 3.0]), (9, [1.0, 2.0, 3.0])]
    assert links(spark, rows) == sorted([
        (None, 1, 5, False), (None, 1, 5, False), (5, 1, 5, True), (5, 1, 5, True), (6, 1, 6, True), (7, 1, 6, False),
        (8, 1, 8, True), (9, 1, 8, False), (9, 1, 8, False)], key=str)
    assert links(spark, [(None, [1.0]), (None, [2.0])]) == [(None, 1, None, False)] * 2


@pytest.mark.parametrize("n", [400, 3200])
def test_recall_while_pivots_grow(spark, monkeypatch, n):
    """Pairs close to the bound, with pivots that grow with the vectors: recall stays."""
    monkeypatch.setattr(p, "SMALL", 100)
    monkeypatch.setattr(p, "PIVOTS", 16)
    assert p.pivots_for(n) == {400: (32, 7), 3200: (64, 7)}[n]
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n // 2, 32))
    noise = rng.normal(size=x.shape)
    noise -= (noise * x).sum(1, keepdims=True) / np.square(x).sum(1, keepdims=True) * x
    y = 0.955 * x / np.linalg.norm(x, axis=1, keepdims=True) + np.sqrt(1 - 0.955 ** 2) * noise / np.linalg.norm(noise, axis=1, keepdims=True)
    vectors = np.concatenate([x, y]).astype(np.float32).tolist()
    found = {r[0]: r[1] for r in links(spark, list(enumerate(vectors)))}
    counts, _ = brute(range(n), vectors)
    assert counts.sum() >= n and sum(found.values()) >= 0.97 * counts.sum()


def test_pivots_grow_with_the_root():
    assert [p.pivots_for(n) for n in (10, 65_536, 65_537, 10**6, 10**9)] == [(256, 6), (256, 6), (512, 7), (1024, 7), (32768, 10)]


def test_every_vector_is_indexed_and_pairs_count_once(spark):
    same = [(i, [1.0, 2.0, 3.0], 0) for i in range(50)]
    found = p.near_duplicates(spark.createDataFrame(same, "vec_id long, embedding array<float>, label int")).collect()
    assert {(r["n_links"], r["component_id"]) for r in found} == {(49, 0)}
