"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers, so sums over rows are exact. The matrix X of centred rows is never built: a
task makes its rows from whole numbers, n * x - S, and divides by n. Every step of the bidiagonalisation is
one job over all rows with two products, Xv for the new left vector and, in the same pass, its transposed
product: the left vectors are X times vectors that the driver holds, so a row has its own entries of all
of them at hand, and the sums U'p (the part to take off again), X'p and p'p follow from one reading. Both
bases are reorthogonalised in full in every step. The driver holds vectors of the dimension only. The
singular values and vectors of the small bidiagonal matrix give the deviations and components.

Steps end with the dimension, or when the residuals of all wanted components are at rounding level, or
where no new direction is left; then another start, orthogonal to all before, finds what a vector of equal
variances hides.

Defined results: rows whose vector is null or empty, or holds a null, a non-finite entry or one too large
for a whole number are left out; vectors of each length are whitened among themselves, with one fit for
each length; components without variance (relative to the first, below `FLAT`) are not returned, so equal
rows, or fewer rows than components, give fewer; no rows give no rows; repeated rows count as often as they
come; a row without an id is whitened like others; a deviation that does not fit a long is null; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import written

SCALE, SHIFT = 64, 1_000_000
FLAT = 1e-12  # least variance of a component, of the first one's
SETTLED = 1e-14  # residual of a component, of the first deviation, at which steps may end
ROWS = 4096  # rows of a packed block, at most
_LONG = 2**62


def whole_vectors(vectors: DataFrame, ident: str, vector: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """`vec_id, dim, x` of usable rows, x as whole numbers."""
    v = F.col("_v")
    finite = ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= F.lit(2.0**56 / scale)))
    rows = vectors.select(F.col(ident).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("_v"))
    rows = rows.where(v.isNotNull() & (F.size(v) > 0) & finite)
    x = F.transform(v, lambda c: F.floor(c * scale).cast("long") + F.lit(shift).cast("long"))
    return rows.select("vec_id", F.size("_v").alias("dim"), x.alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def packed(rows: DataFrame) -> DataFrame:
    """`dim, n, data`: rows of one length of a batch as the bytes of a matrix. Nothing is shuffled."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                dims = batch.column("dim").to_numpy()
                for dim in np.unique(dims):
                    x = matrix(batch.column("x").filter(pa.array(dims == dim)))
                    columns = [pa.array([dim], pa.int32()), pa.array([len(x)], pa.int64()), pa.array([x.astype(np.int64).tobytes()], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["dim", "n", "data"])

    return rows.select("dim", "x").mapInArrow(work, "dim int, n long, data binary")


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for value in batch.column("data"):
            yield np.frombuffer(value.as_buffer(), np.int64).reshape(-1, dim)


def summed(blocks: DataFrame, dim: int, work, entries: int, kind: str = "double") -> np.ndarray:
    """The sum over all blocks of `work(block)`, an array of `entries` numbers. Tasks add up their own blocks."""
    numbers = pa.float64() if kind == "double" else pa.int64()

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in _blocks(batches, dim):
            found = work(block)
            total = found if total is None else total + found
        if total is not None:
            at = pa.array(np.arange(entries), pa.int32())
            yield pa.RecordBatch.from_arrays([at, pa.array(total, numbers)], names=["at", "v"])

    parts = blocks.select("data").mapInArrow(partial, f"at int, v {kind}")
    found = parts.groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(entries, np.float64 if kind == "double" else np.int64)
    out[found.column("at").to_numpy()] = found.column("v").to_numpy()
    return out


@dataclass(frozen=True)
class Centre:
    """Number of rows and exact sums of each dimension. `base` is a whole number near each mean."""

    n: int
    sums: tuple[int, ...]

    @property
    def base(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s - self.n * (s // self.n) for s in self.sums], np.int64)

    def spread(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: in 64 bits where they hold it, else in Python's whole numbers."""
        near = x - self.base
        if len(x) and (int(np.abs(near).max()) + 1) * self.n >= _LONG:
            near = near.astype(object)
        return near * self.n - self.rest

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Centred rows, each entry rounded once."""
        return (self.spread(x) / self.n).astype(np.float64)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The sum of squares of n * x - S of each row, exact."""
        far = self.spread(x)
        most = int(np.abs(far).max(initial=0)) if far.size else 0
        if far.dtype == object or most * most * max(1, x.shape[1]) >= _LONG:
            found = (far.astype(object) ** 2).sum(axis=1).tolist()
            return [int(f) if f < 2**63 else None for f in found]
        return (far * far).sum(axis=1).tolist()


def centre_of(blocks: DataFrame, dim: int) -> Centre:
    # Halves of 32 bits are summed apart, so that sums of large entries do not overflow.
    def work(x: np.ndarray) -> np.ndarray:
        return np.r_[len(x), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]

    found = summed(blocks, dim, work, 2 * dim + 1, "long").tolist()
    return Centre(found[0], tuple((h << 32) + low for h, low in zip(found[1 : dim + 1], found[dim + 1 :])))


def _off(vector: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """A vector without its part in an orthonormal basis, taken off twice."""
    for _ in range(2 if basis else 0):
        b = np.array(basis)
        vector = vector - b.T @ (b @ vector)
    return vector


@dataclass(frozen=True)
class Whitening:
    centre: Centre
    components: np.ndarray  # a row each
    variances: np.ndarray
    trace: float

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.centre.rows(x) @ (self.components / np.sqrt(self.variances)[:, None]).T


def bidiagonalise(blocks: DataFrame, dim: int, centre: Centre, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """Components (rows), singular values and the squared norm of the centred rows.

    With u_j = X w_j, one pass with p = X z sums U'p, X'p and p'p. What is taken off p for
    orthogonality is taken off z and X'p as well, as X'u_j is known.
    """
    draw = np.random.default_rng(seed)
    right: list[np.ndarray] = []  # v_j
    left: list[np.ndarray] = []  # w_j, so that u_j = X w_j
    turned: list[np.ndarray] = []  # X'u_j, as the driver knows it
    entries = {}  # of the bidiagonal matrix B, X V = U B
    trace = float(summed(blocks, dim, lambda x: np.array([np.square(centre.rows(x)).sum()]), 1)[0])
    size = np.sqrt(trace)
    if not size:
        return np.zeros((0, dim)), np.zeros(0), 0.0

    def products(z: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """U'p, X'p and p'p of p = X z."""
        known = np.array(left).reshape(-1, dim)

        def work(x: np.ndarray) -> np.ndarray:
            rows = centre.rows(x)
            p = rows @ z
            return np.r_[(rows @ known.T).T @ p, rows.T @ p, p @ p]

        found = summed(blocks, dim, work, len(known) + dim + 1)
        return found[: len(known)], found[len(known) : -1], float(found[-1])

    v = _off(draw.normal(size=dim), right)
    v /= np.linalg.norm(v)
    beta, restarts = 0.0, 0
    while len(right) < dim:
        at = len(right)
        right.append(v)
        z = v - beta * left[-1] if beta else v.copy()
        inside, back, square = products(z)
        if left:
            # Full reorthogonalisation of p against all left vectors.
            z = z - np.array(left).T @ inside
            back = back - np.array(turned).T @ inside
            square = square - float(inside @ inside)
        alpha = np.sqrt(max(square, 0.0))
        if alpha <= 1e-13 * size:
            # X v lies in what is known already: no left vector of its own.
            alpha, following = 0.0, np.zeros(dim)
        else:
            left.append(z / alpha)
            turned.append(back / alpha)
            following = turned[-1] - alpha * v
        entries[at, at] = alpha
        following = _off(following, right)
        beta = float(np.linalg.norm(following))
        if len(right) == dim:
            break
        if beta <= 1e-13 * size or not alpha:
            # Another start where this one has no further direction.
            beta, following = 0.0, _off(draw.normal(size=dim), right)
            restarts += 1
        elif _settled(entries, at + 1, beta, wanted):
            break
        else:
            entries[at, at + 1] = beta
        v = following / np.linalg.norm(following)
    k = len(right)
    b = _small(entries, k)
    _, values, turn = np.linalg.svd(b)
    return turn @ np.array(right), values, trace


def _small(entries: dict[tuple[int, int], float], k: int) -> np.ndarray:
    b = np.zeros((k, k))
    for (i, j), value in entries.items():
        if j < k:
            b[i, j] = value
    return b


def _settled(entries, k: int, beta: float, wanted: int) -> bool:
    """Whether the wanted components have residuals at rounding level."""
    if k <= wanted:
        return False
    outer, values, _ = np.linalg.svd(_small(entries, k))
    return bool(np.all(beta * np.abs(outer[-1, :wanted]) <= SETTLED * values[0]))


def fit(blocks: DataFrame, dim: int, wanted: int) -> Whitening:
    """Components by falling variance, at most `wanted`, of all rows of a length."""
    mine = blocks.where(F.col("dim") == dim)
    centre = centre_of(mine, dim)
    components, values, squares = bidiagonalise(mine, dim, centre, wanted)
    variances = values**2 / centre.n
    kept = np.flatnonzero(variances > FLAT * variances.max(initial=0))[:wanted]
    return Whitening(centre, components[kept], variances[kept], squares / centre.n)


def identity_error(blocks: DataFrame, dim: int, model: Whitening) -> float:
    """The largest absolute entry of the covariance of whitened rows minus the identity."""
    k = len(model.variances)

    def work(x: np.ndarray) -> np.ndarray:
        rows = model.rows(x)
        return np.r_[rows.sum(axis=0), (rows.T @ rows).ravel()]

    found = summed(blocks.where(F.col("dim") == dim), dim, work, k + k * k)
    mean = found[:k] / model.centre.n
    covariance = found[k:].reshape(k, k) / model.centre.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max(initial=0))


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, ident: str = "vec_id", vector: str = "embedding", wanted: int = 32) -> DataFrame:
    """One row for each usable row and component: `vec_id, component` (from 1), `n`, `deviation` (the sum
    of squares of n * x - S), `whitened`, `explained` (share of the variance), `identity_error`."""
    rows = whole_vectors(vectors, ident, vector)
    blocks = written(packed(rows), "blocks")
    lengths = sorted(r[0] for r in blocks.select("dim").distinct().collect())
    models = {}
    for dim in lengths:
        model = fit(blocks, dim, wanted)
        models[dim] = (model, identity_error(blocks, dim, model))
    shared = vectors.sparkSession.sparkContext.broadcast(models)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                dims = batch.column("dim").to_numpy()
                for dim in np.unique(dims):
                    model, error = shared.value[int(dim)]
                    part = batch.filter(pa.array(dims == dim))
                    x, k = matrix(part.column("x")), len(model.variances)
                    far = model.centre.deviation(x)
                    each = np.repeat(np.arange(len(x)), k)
                    share = model.variances / model.trace if model.trace else model.variances
                    columns = [
                        part.column("vec_id").take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                        pa.array(np.full(len(each), model.centre.n), pa.int64()),
                        pa.array(far, pa.int64()).take(pa.array(each)),
                        pa.array(model.rows(x).ravel(), pa.float64()),
                        pa.array(np.tile(share, len(x)), pa.float64()),
                        pa.array(np.full(len(each), error), pa.float64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in RESULT.split(", ")])

    return rows.mapInArrow(work, RESULT)
