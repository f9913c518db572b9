"""Embedding whitening: components of the covariance by contour integration.

The leading part of the spectrum is cut into intervals that hold a few eigenvalues each. A quadrature of complex shifted
solves along a circle round an interval projects a small subspace onto its eigenvectors, Rayleigh-Ritz extracts them, and
the difference of the inertia of the covariance shifted to both ends says how many there must be.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize

# An entry c stands for floor(SCALE * c) + SHIFT; components that are given.
SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16

REACH = float(1 << 52)  # SCALE * c is cut to this size either way: products then fit 38 digits
LIMB = 21               # bits of a part of a large entry: sums of its products are exact in doubles
CHUNK = 1024            # vectors multiplied at a time
LONG = 1 << 63

EACH = 4                # eigenvalues of an interval
CLUSTER = 1e-9          # eigenvalues closer than this part of the largest are found together
NODES = 8               # quadrature points on its upper half circle
ROUNDS = 100
EXACT = 1e-13           # residual at which a subspace that gets no better is taken
RANK = 1e-11            # components below this part of the largest are rounding, not spread


def matrices(column: pa.Array):
    """(row numbers, entries less SHIFT) of the usable vectors of each length in an Arrow list column."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes[sizes > 0]).tolist():
        at = np.flatnonzero(sizes == size)
        flat = (column if len(at) == len(column) else column.take(pa.array(at))).flatten()
        values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, size)
        fine = np.isfinite(values).all(1)
        yield at[fine], np.floor(np.clip(values[fine] * SCALE, -REACH, REACH)).astype(np.int64)


def packed(vectors: np.ndarray):
    """Arrow arrays of the vectors as bytes: the width of an entry, then the entries in the least width that holds all."""
    top = np.where(vectors < 0, ~vectors, vectors).max(1)
    width = np.select([top < 1 << 7, top < 1 << 15, top < 1 << 31], [1, 2, 4], 8)
    for w in np.unique(width).tolist():
        some = vectors[width == w].astype(f"<i{w}")
        raw = np.ascontiguousarray(np.concatenate([np.full((len(some), 1), w, np.uint8), some.view(np.uint8).reshape(len(some), -1)], 1))
        yield pa.FixedSizeBinaryArray.from_buffers(pa.binary(raw.shape[1]), len(raw), [None, pa.py_buffer(raw)]).cast(pa.binary())


def unpacked(column: pa.Array):
    """(entries) of each length and width in an Arrow binary column, chunk by chunk."""
    column = column.cast(pa.large_binary())
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    widths = np.array([b[0] for b in column.to_pylist()], np.uint8) if len(column) else np.zeros(0, np.uint8)
    for size, w in sorted(set(zip(sizes.tolist(), widths.tolist()))):
        some = column.filter(pa.array((sizes == size) & (widths == w)))
        raw = np.frombuffer(b"".join(some.to_pylist()), np.uint8).reshape(-1, size)[:, 1:]
        for a in range(0, len(raw), CHUNK):
            yield np.ascontiguousarray(raw[a:a + CHUNK]).view(f"<i{w}").astype(np.int64)


def fit_list(vectors: DataFrame) -> DataFrame:
    """Each different vector once, as (length, vector in bytes)."""
    def run(batches):
        for batch in batches:
            for _, whole in matrices(batch.column(0)):
                for some in packed(whole):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), whole.shape[1], np.int32)), some], ["length", "vector"])

    return vectors.select("embedding").mapInArrow(run, "length int, vector binary").distinct()


def exact(x: np.ndarray) -> np.ndarray:
    return x.astype(np.int64).astype(object)


def gram(y: np.ndarray) -> np.ndarray:
    """y' y in Python integers. Rows are at most CHUNK."""
    top = float(np.abs(y).max(initial=0))
    if top * top * len(y) < 2 ** 53:
        return exact(y.astype(float).T @ y.astype(float))
    limbs, rest = [], y
    while not limbs or ((rest != 0) & (rest != -1)).any():
        limbs.append((rest & ((1 << LIMB) - 1)).astype(float))
        rest = rest >> LIMB
    limbs.append(rest.astype(float))  # 0 or -1: the sign
    total = np.zeros((y.shape[1],) * 2, object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            total += exact(a.T @ b) * (1 << LIMB * (i + j))
    return total


def decimals(values: list[int]) -> pa.Array:
    return pa.array([Decimal(v) for v in values], pa.decimal128(38, 0))


def sums(fitted: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and sums of their entries, by length."""
    def run(batches):
        found: dict[int, list] = {}
        for batch in batches:
            for y in unpacked(batch.column(0)):
                n, s = found.get(y.shape[1], (0, 0))
                # Two halves of an entry, each of which can be added up in 64 bits.
                high, low = y >> 32, y & 0xFFFFFFFF
                found[y.shape[1]] = n + len(y), s + high.sum(0).astype(object) * (1 << 32) + low.sum(0).astype(object)
        for length, (n, s) in found.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([length] * length, pa.int32()), pa.array(range(length), pa.int32()),
                pa.array([n] * length, pa.int64()), decimals(s.tolist())], ["length", "place", "n", "total"])

    rows = fitted.select("vector").mapInArrow(run, "length int, place int, n long, total decimal(38,0)").groupBy(
        "length", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(rows, key=lambda r: (r["length"], r["place"])):
        out.setdefault(r["length"], (r["n"], []))[1].append(int(r["total"]))
    return out


def covariances(fitted: DataFrame, totals: dict[int, tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """Covariance over the fit list by length, divisor n. Entries are centred to the whole number next to their mean, the
    products are added up exactly, and what the rounded centre leaves over is taken off exactly."""
    centres = {d: np.array([(2 * s + n) // (2 * n) for s in total], np.int64) for d, (n, total) in totals.items()}

    def run(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for y in unpacked(batch.column(0)):
                d = y.shape[1]
                found[d] = found.get(d, 0) + gram(y - centres[d])
        for d, products in found.items():
            i, j = np.triu_indices(d)
            for a in range(0, len(i), 100_000):
                some = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(i[some]), d, np.int32)), pa.array(i[some].astype(np.int32)),
                    pa.array(j[some].astype(np.int32)), decimals(products[i[some], j[some]].tolist())],
                    ["length", "i", "j", "product"])

    rows = fitted.select("vector").mapInArrow(run, "length int, i int, j int, product decimal(38,0)").groupBy(
        "length", "i", "j").agg(F.sum("product").alias("product")).collect()
    out = {d: np.zeros((d, d)) for d in totals}
    left = {d: [s - n * int(c) for s, c in zip(total, centres[d].tolist())] for d, (n, total) in totals.items()}
    for r in rows:
        d, i, j = r["length"], r["i"], r["j"]
        n = totals[d][0]
        out[d][i, j] = out[d][j, i] = (n * int(r["product"]) - left[d][i] * left[d][j]) / (n * n)
    return out


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and squared off-diagonal of a symmetric matrix after Householder reflections: a congruence, so that
    shifts of both have the same inertia."""
    a = a.copy()
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1:, k].copy()
        size = np.linalg.norm(x)
        if not size:
            continue
        x[0] += size if x[0] >= 0 else -size
        x /= np.linalg.norm(x)
        a[k + 1:, k:] -= 2 * np.outer(x, x @ a[k + 1:, k:])
        a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ x, x)
    return np.diag(a).copy(), np.square(np.diag(a, 1))


def above(tri: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """Number of eigenvalues above a shift: the positive pivots of the shifted matrix (Sylvester's law of inertia)."""
    diagonal, off = tri
    tiny = np.finfo(float).eps * (np.abs(diagonal).max() + np.sqrt(off.max(initial=0)) + 1e-300)
    count, pivot = 0, 1.0
    for i, x in enumerate(diagonal.tolist()):
        pivot = x - shift - (off[i - 1] / pivot if i else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot > 0
    return count


def located(tri, place: int, low: float, high: float) -> float:
    """The eigenvalue of a place (0 is the largest) between two bounds, halved by inertia to rounding size."""
    while high - low > 1e-14 * high:
        middle = (low + high) / 2
        if middle in (low, high):
            break
        low, high = (middle, high) if above(tri, middle) > place else (low, middle)
    return (low + high) / 2


def intervals(values: list[float], wanted: int, each: int = EACH) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) of circles that hold the first ``wanted`` of the falling eigenvalues, whose next one
    is also in the list. A group is cut at its widest gap until it is small and stands well apart from its neighbours."""
    todo, done = [(0, wanted)], []
    while todo:
        a, b = todo.pop()
        width = values[a] - values[b - 1]
        apart = min(values[a - 1] - values[a] if a else np.inf, values[b - 1] - values[b])
        if b - a == 1 or width < CLUSTER * values[0] or b - a <= each and width <= 4 * apart:
            done.append((values[b - 1] - apart / 2, values[a] + apart / 2, b - a))
        else:
            cut = a + 1 + int(np.argmax(-np.diff(values[a:b])))
            todo += [(a, cut), (cut, b)]
    return done


def ritz(matrix: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    basis, _ = np.linalg.qr(basis)
    small = basis.T @ matrix @ basis
    values, turns = np.linalg.eigh((small + small.T) / 2)
    return values, basis @ turns


def contour(matrix: np.ndarray, low: float, high: float, inside: int, seed: int = 5) -> np.ndarray:
    """Eigenvectors of the eigenvalues between two bounds, of which there are ``inside``."""
    d = len(matrix)
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    angles = np.pi / 2 * (nodes + 1)
    centre, radius = (low + high) / 2, (high - low) / 2
    norm = np.abs(matrix).sum(1).max()
    size, best, rounds = min(d, max(2 * inside, inside + 4)), np.inf, 0
    basis = np.random.default_rng(seed).normal(size=(d, size))
    kept = None
    while rounds < ROUNDS:
        rounds += 1
        projected = np.zeros((d, size))
        for angle, weight in zip(angles, weights):
            way = radius * np.exp(1j * angle)
            solved = np.linalg.solve((centre + way) * np.eye(d) - matrix, basis.astype(complex))
            projected += weight / 2 * (way * solved).real
        values, basis = ritz(matrix, projected)
        found = (values > low) & (values <= high)
        if found.sum() == inside:
            wrong = np.linalg.norm(matrix @ basis[:, found] - basis[:, found] * values[found], axis=0).max() / norm
            if wrong < best:
                settled, kept, best = wrong > best / 2, basis[:, found], wrong
            else:
                settled = True
            if best < 1e-16 or settled and best < EXACT:
                return kept
        if rounds % 8 == 0 and size < d:  # too small a subspace for what lies near the circle
            more = min(d, 2 * size)
            basis = np.concatenate([basis, np.random.default_rng(seed + rounds).normal(size=(d, more - size))], 1)
            size = more
    raise RuntimeError(f"{inside} eigenvalues lie between {low} and {high}, but they were not found")


def leading(matrix: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as rows; those of rounding size are left out."""
    d, scale = len(matrix), np.trace(matrix)
    if not scale > 0:
        return np.zeros(0), np.zeros((0, d))
    scaled = matrix / scale
    tri = tridiagonal(scaled)
    largest = located(tri, 0, 0.0, 1 + 1e-6)
    rank = above(tri, RANK * largest)
    wanted = min(most, rank)
    values = [located(tri, i, 0.0, largest * (1 + 1e-12)) for i in range(wanted)]
    while len(values) < rank:  # the next one, and the rest of a cluster that the last one wanted is in
        values.append(located(tri, len(values), 0.0, largest * (1 + 1e-12)))
        if values[-2] - values[-1] > CLUSTER * largest:
            break
        wanted += 1
    if len(values) == wanted:
        values.append(0.0)
    found = []
    for low, high, inside in intervals(values, wanted):
        if above(tri, low) - above(tri, high) != inside:
            raise RuntimeError(f"inertia gives another number than {inside} of eigenvalues between {low} and {high}")
        found.append(contour(scaled, low, high, inside))
    values, vectors = ritz(matrix, np.concatenate(found, 1))
    chosen = np.argsort(-values, kind="stable")[:min(most, wanted)]
    rows = vectors[:, chosen].T
    values = values[chosen]
    signs = np.sign(rows[np.arange(len(rows)), np.abs(rows).argmax(1)])
    return values, rows * signs[:, None]


@dataclass(frozen=True)
class Whitening:
    """What turns vectors of one length into whitened ones: sums are of entries less SHIFT."""
    n: int
    total: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def apply(self, y: np.ndarray) -> np.ndarray:
        mean = np.array([t / self.n for t in self.total])
        return (y - mean) @ self.vectors.T / np.sqrt(self.values)

    def deviation(self, y: np.ndarray) -> list[int | None]:
        """Sum over the entries of (n x - S)^2, exact; None where a long cannot hold it."""
        most = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.total))
        if most * most * y.shape[1] < LONG:
            return np.square(self.n * y - np.array(self.total, np.int64)).sum(1).tolist()
        whole = ((self.n * y.astype(object) - np.array(self.total, object)) ** 2).sum(1).tolist()
        return [v if v < LONG else None for v in whole]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[dict[int, Whitening], float | None]:
    """The whitening of each length, and the largest entry by which the covariance of the whitened fit list differs from
    the identity."""
    fitted = materialize(fit_list(vectors), "fit-list")
    totals = sums(fitted)
    models = {}
    for d, matrix in covariances(fitted, totals).items():
        values, rows = leading(matrix, components)
        if len(values):
            models[d] = Whitening(totals[d][0], totals[d][1], values, rows, float(np.trace(matrix)))
    return models, identity_error(fitted, models)


def identity_error(fitted: DataFrame, models: dict[int, Whitening]) -> float | None:
    if not models:
        return None

    def run(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for y in unpacked(batch.column(0)):
                if y.shape[1] in models:
                    white = models[y.shape[1]].apply(y)
                    with_one = np.concatenate([white, np.ones((len(white), 1))], 1)
                    found[y.shape[1]] = found.get(y.shape[1], 0) + with_one.T @ with_one
        for d, products in found.items():
            i, j = np.triu_indices(len(products))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                pa.array(products[i, j])], ["length", "i", "j", "product"])

    rows = fitted.select("vector").mapInArrow(run, "length int, i int, j int, product double").groupBy(
        "length", "i", "j").agg(F.sum("product").alias("product")).collect()
    worst = 0.0
    for d, model in models.items():
        k = len(model.values)
        means = {r["i"]: r["product"] / model.n for r in rows if r["length"] == d and r["j"] == k}
        for r in rows:
            if r["length"] == d and r["j"] < k:
                spread = r["product"] / model.n - means[r["i"]] * means[r["j"]]
                worst = max(worst, abs(spread - (r["i"] == r["j"])))
    return worst


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Project vectors on the leading components of their covariance, scaled to unit variance.

    An entry c counts as floor(64 c) + 1000000; the covariance is over each different vector once. Returns one row per
    usable vector and component: vec_id, component (from 1, by falling eigenvalue), n (different vectors), deviation
    (sum over the entries of (n x - S)^2; null where a long cannot hold it), whitened, explained (share of the trace),
    identity_error (one value: how far the covariance of the whitened fit list is from the identity).

    Null vectors and those that hold null or non-finite entries give no rows, nor do empty vectors. Vectors of each
    length are whitened among themselves. Components whose variance is below 1e-11 of the largest are rounding and are
    left out; a fit list of one vector has none, and gives no rows. Null ids and repeated rows each give their rows;
    other columns are ignored; an empty table gives an empty one. 64 c is cut to 2**52 either way.

    Only sums, d x d products and the components of a length d reach the driver; no vectors do.
    """
    models, error = fit(vectors, components)

    def run(batches):
        for batch in batches:
            for at, y in matrices(batch.column(1)):
                model = models.get(y.shape[1])
                if model is None or not len(y):
                    continue
                k = len(model.values)
                rows, which = np.repeat(at, k), np.tile(np.arange(k), len(at))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(rows)), pa.array((which + 1).astype(np.int32)),
                    pa.array(np.full(len(rows), model.n)), pa.array(model.deviation(y), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k))),
                    pa.array(model.apply(y).ravel()), pa.array((model.values / model.trace)[which]),
                    pa.array(np.full(len(rows), error))], names)

    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding")
    return rows.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, "
                                "identity_error double")
