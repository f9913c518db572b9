import numpy as np
import pytest

from millrace.llm import contour_whitening as C

SCHEMA = "vec_id long, embedding array<double>, component int, whitened string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)


def usable(rows):
    return [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]


def brute(rows):
    """Whitening in dense numpy, for vectors of one length: (x, components, values, n, trace, sums)."""
    x = np.array([np.floor(64 * np.array(v, float)).astype(np.int64) + 1_000_000 for _, v in usable(rows)])
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(0)
    cov = centred.T @ centred / len(fit)
    values, vectors = np.linalg.eigh(cov)
    return x, vectors[:, ::-1].T, values[::-1], len(fit), np.trace(cov), fit.sum(0)


def check(spark, rows, components=16, repartition=None):
    df = frame(spark, rows)
    got = C.whiten(df.repartition(repartition) if repartition else df, components).collect()
    x, vectors, values, n, trace, sums = brute(rows)
    k = min(components, int((values > 1e-11 * values[0]).sum()))
    ids = [i for i, _ in usable(rows)]
    assert len(got) == k * len(ids)
    assert {r["component"] for r in got} == set(range(1, k + 1))
    deviation = ((n * x.astype(object) - sums.astype(object)) ** 2).sum(1).tolist()
    whitened = (x - sums / n) @ vectors[:k].T / np.sqrt(values[:k])
    for c in range(1, k + 1):
        mine = sorted((r["vec_id"] is None, r["vec_id"] or 0, r["deviation"], r["whitened"]) for r in got if r["component"] == c)
        for way in (1, -1):
            want = sorted((i is None, i or 0, d, way * w) for i, d, w in zip(ids, deviation, whitened[:, c - 1]))
            if [m[:3] for m in mine] == [w[:3] for w in want] and np.allclose([m[3] for m in mine], [w[3] for w in want], atol=1e-6):
                break
        else:
            raise AssertionError(f"component {c} differs")
    assert all(r["n"] == n and r["identity_error"] < 1e-4 for r in got)
    assert all(abs(r["explained"] / (values[r["component"] - 1] / trace) - 1) < 1e-4 for r in got)


def vectors(rng, n, d, falling=0.8):
    return [(i, (v * falling ** np.arange(d)).tolist()) for i, v in enumerate(rng.normal(size=(n, d)) * 3)]


def test_equals_dense_whitening(spark):
    rng = np.random.default_rng(1)
    rows = vectors(rng, 300, 24)
    rows += [rows[0]] * 200 + [(None, rows[1][1]), (7, rows[2][1])]  # a hot vector, a null id, an id twice
    rows += [(900, None), (901, [float("nan")] * 24), (902, [1.0] * 23 + [None]), (903, [float("inf")] * 24), (904, [])]
    rows += [(905, [0.0] * 24)]
    check(spark, rows, repartition=7)


@pytest.mark.parametrize("d", [1, 2, 5])
def test_few_dimensions(spark, d):
    check(spark, vectors(np.random.default_rng(d), 60, d))


def test_low_rank_and_single_vectors(spark):
    rng = np.random.default_rng(2)
    check(spark, vectors(rng, 6, 12, 1.0))  # five components at most
    assert C.whiten(frame(spark, [(1, [0.5, 2.0]), (2, [0.5, 2.0])])).collect() == []
    assert C.whiten(frame(spark, [])).collect() == []
    assert C.whiten(frame(spark, [(1, None)])).collect() == []


def test_lengths_are_apart_and_long_deviations_are_null(spark):
    rng = np.random.default_rng(3)
    short, long = vectors(rng, 40, 3), [(i + 100, v) for i, v in vectors(rng, 50, 6)]
    both = {(r["vec_id"], r["component"]): (r["n"], r["deviation"], r["explained"]) for r in C.whiten(frame(spark, short + long)).collect()}
    for part in (short, long):
        for r in C.whiten(frame(spark, part)).collect():
            n, deviation, explained = both[r["vec_id"], r["component"]]
            assert (n, deviation) == (r["n"], r["deviation"]) and abs(explained - r["explained"]) < 1e-12
    far = C.whiten(frame(spark, [(1, [1e12, 0.0]), (2, [0.0, 1.0]), (3, [-1e300, 2.0])])).collect()
    assert far and all(r["deviation"] is None for r in far if r["vec_id"] == 3)


def test_bytes_of_vectors_round_trip():
    rng = np.random.default_rng(4)
    for top in (100, 30_000, 2**30, 2**52):
        y = rng.integers(-top, top, (50, 5))
        y[0] = [127, -128, 0, 1, -1]
        back = np.concatenate([part for some in C.packed(y) for part in C.unpacked(some)])
        assert sorted(map(tuple, back.tolist())) == sorted(map(tuple, y.tolist()))


def test_products_are_exact():
    rng = np.random.default_rng(5)
    for top in (50, 2**20, 2**35, 2**52):
        y = rng.integers(-top, top, (300, 4))
        assert (C.gram(y) == y.astype(object).T @ y.astype(object)).all()


def test_components_of_hard_spectra():
    rng = np.random.default_rng(6)

    def against(matrix, tolerance=1e-9):
        values, rows = C.leading(matrix)
        want = np.linalg.eigvalsh(matrix)[::-1]
        k = min(16, int((want > 1e-11 * want[0]).sum()))
        assert len(values) == k and np.allclose(values, want[:k], rtol=1e-4, atol=1e-13 * want[0])
        assert np.abs(rows @ rows.T - np.eye(k)).max() < 1e-12
        assert np.linalg.norm(matrix @ rows.T - rows.T * values, axis=0).max() < tolerance * want[0]

    basis, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    for spectrum in (np.ones(40), np.r_[np.ones(20), np.zeros(20)], 10.0 ** -np.arange(40), np.r_[1e6, np.ones(39)],
                     np.r_[np.linspace(2, 1, 15), np.full(25, 0.5)], np.r_[np.linspace(2, 1, 14), np.full(3, 0.9), np.full(23, 0.1)],
                     1 + 1e-7 * np.arange(40), np.r_[1, np.zeros(39)]):
        against(basis * spectrum @ basis.T)
    assert len(C.leading(np.zeros((3, 3)))[0]) == 0


def test_inertia_counts():
    rng = np.random.default_rng(7)
    a = rng.normal(size=(30, 30))
    a = a + a.T
    tri = C.tridiagonal(a)
    values = np.linalg.eigvalsh(a)
    for shift in rng.uniform(values[0] - 1, values[-1] + 1, 50):
        assert C.above(tri, shift) == (values > shift).sum()
