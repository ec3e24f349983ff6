"""Whitened embeddings: principal components by contour integration (FEAST).

Spark makes the sums over the vectors: integer sums per dimension, then cross
products of exactly centred entries. What reaches the driver is the covariance,
whose size is the square of the dimension and not of the corpus. There the
spectrum is cut into intervals at wide gaps. For each interval a quadrature of
complex shifted solves filters a random subspace, a Rayleigh-Ritz step takes the
components out of it, and the inertia of the shifted covariance says how many
there must be: fewer or more, and the interval is done again with more columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import map_batches, sum_matrices

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
#: Entries whose integer would leave the long range have no x.
LARGEST = 2.0**56
PER_INTERVAL = 8
NODES = 8
LIMB = 31

SCHEMA = (
    "vec_id bigint, component int, n bigint, deviation bigint, "
    "whitened double, explained double, identity_error double"
)


@dataclass(frozen=True)
class Whitening:
    """Centre ``whole + rest / n`` of the integers (offset left out), the
    components as columns, their eigenvalues and shares of the trace."""

    n: int
    whole: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0


# --- spectrum of a symmetric matrix -----------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a similar tridiagonal matrix (reflections)."""
    a = np.array(matrix, dtype=float)
    for k in range(len(a) - 2):
        x = a[k + 1 :, k]
        norm = np.linalg.norm(x)
        if not norm or not np.any(x[1:]):
            continue
        v = x.copy()
        v[0] += np.copysign(norm, x[0])
        v /= np.linalg.norm(v)
        for part in (a[k + 1 :, k:], a.T[k + 1 :, k:]):
            part -= 2 * np.outer(v, v @ part)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_below(
    diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray
) -> np.ndarray:
    """Inertia: how many eigenvalues lie below each shift, as the number of
    negative pivots of the shifted matrix."""
    least = np.finfo(float).tiny
    squares = np.concatenate([[0.0], off**2])
    pivots, negative = np.ones(len(shifts)), np.zeros(len(shifts), dtype=int)
    for d, square in zip(diagonal, squares, strict=True):
        pivots = d - shifts - square / pivots
        pivots[np.abs(pivots) < least] = -least
        negative += pivots < 0
    return negative


def locate(diagonal: np.ndarray, off: np.ndarray) -> np.ndarray:
    """All eigenvalues, falling, each bisected by inertia counts."""
    size = len(diagonal)
    reach = np.abs(np.concatenate([off, [0.0]])) + np.abs(np.concatenate([[0.0], off]))
    low = np.full(size, (diagonal - reach).min() - 1e-300)
    high = np.full(size, (diagonal + reach).max())
    high += np.abs(high) * 1e-15 + 1e-300
    want = np.arange(1, size + 1)
    for _ in range(70):
        middle = (low + high) / 2
        above = size - count_below(diagonal, off, middle)
        low, high = np.where(above >= want, middle, low), np.where(
            above >= want, high, middle
        )
    return (low + high) / 2


def intervals(places: np.ndarray, wanted: int) -> list[tuple[float, float]]:
    """Falling intervals that hold the first ``wanted`` eigenvalues, cut in the
    widest gap of some at a time; a tight cluster is never cut."""
    scale = max(abs(places[0]), abs(places[-1]))
    ends = np.append(places, places[-1] - scale)
    gaps = ends[:-1] - ends[1:]
    cuts, start = [places[0] + max(gaps[0], scale * 1e-3)], 0
    while start < wanted:
        stop = min(start + PER_INTERVAL, len(places))
        while stop < len(places) and gaps[start:stop].max() < scale * 1e-10:
            stop += 1
        start += int(np.argmax(gaps[start:stop])) + 1
        cuts.append((ends[start - 1] + ends[start]) / 2)
    return list(zip(cuts[1:], cuts[:-1], strict=True))


def interval_vectors(
    matrix: np.ndarray, low: float, high: float, count: int, seed: int = 0
) -> np.ndarray:
    """Orthonormal eigenvectors with eigenvalues in (low, high), ``count`` of
    them by inertia. Raises if the whole space does not give that many."""
    size = len(matrix)
    norm = np.abs(matrix).sum(axis=1).max()
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turns = np.exp(1j * np.pi / 2 * (nodes + 1))
    centre, radius = (low + high) / 2, (high - low) / 2
    columns = min(size, count + max(8, count // 2))
    random = np.random.default_rng(seed)
    while True:
        basis, last = random.standard_normal((size, columns)), np.inf
        for _ in range(40 if columns < size else 1):
            if columns < size:
                found = np.zeros_like(basis)
                for turn, weight in zip(turns, weights, strict=True):
                    shifted = (centre + radius * turn) * np.eye(size) - matrix
                    part = np.linalg.solve(shifted, basis.astype(complex))
                    found += weight / 2 * (radius * turn * part).real
                basis = found
            basis, _ = np.linalg.qr(basis)
            values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
            basis = basis @ turned
            inside = (values > low) & (values < high)
            if inside.sum() != count:
                continue
            vectors = basis[:, inside]
            error = np.abs(matrix @ vectors - vectors * values[inside]).max()
            if error <= 4e-15 * norm or (error <= 1e-12 * norm and error > last / 2):
                return vectors
            last = error
        if columns == size:
            if inside.sum() == count:
                return basis[:, inside]
            raise RuntimeError(f"{inside.sum()} components found, inertia {count}")
        columns = min(size, 2 * columns)


def leading_components(
    covariance: np.ndarray, wanted: int = COMPONENTS
) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``wanted`` largest eigenvalues, falling, and their unit vectors as
    columns, each with its largest entry positive. Eigenvalues that rounding
    cannot tell from zero are left out."""
    size = len(covariance)
    top = np.abs(covariance).max(initial=0.0)
    if not top:
        return np.zeros(0), np.zeros((size, 0))
    matrix = (covariance + covariance.T) / (2 * top)
    diagonal, off = tridiagonal(matrix)
    places = locate(diagonal, off)
    floor = 16 * size * np.finfo(float).eps * places[0]
    wanted = min(wanted, int((places > floor).sum()))
    found = []
    for seed, (low, high) in enumerate(intervals(places, wanted)):
        below = count_below(diagonal, off, np.array([low, high]))
        found.append(interval_vectors(matrix, low, high, below[1] - below[0], seed))
    basis, _ = np.linalg.qr(np.hstack(found))
    values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
    values, vectors = values[::-1][:wanted], (basis @ turned)[:, ::-1][:, :wanted]
    heads = vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)]
    return values * top, vectors * np.where(heads < 0, -1.0, 1.0)


# --- sums over the vectors ---------------------------------------------------


def usable(vectors: DataFrame, id_col: str, column: str) -> DataFrame:
    """(vec_id, entries) of vectors without null or non-finite entries."""
    entries = F.col(column).cast("array<double>")
    fine = F.forall(
        entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST))
    )
    return vectors.filter(F.col(column).isNotNull() & fine).select(
        F.col(id_col).cast("long").alias("vec_id"), entries.alias("entries")
    )


def _integers(batch: pa.RecordBatch, size: int) -> np.ndarray:
    entries = batch.column(batch.schema.get_field_index("entries"))
    flat = entries.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).astype(np.int64).reshape(-1, size)


def _centred(model: Whitening, ys: np.ndarray) -> np.ndarray:
    return (ys - model.whole).astype(float) - model.rest / max(model.n, 1)


def _sums(rows: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums of floor(64 c) per dimension."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            ys = _integers(batch, size)
            n += len(ys)
            high += (ys >> LIMB).sum(axis=0)
            low += (ys & ((1 << LIMB) - 1)).sum(axis=0)
        columns = [np.arange(size, dtype=np.int32), np.full(size, n), high, low]
        names = ["d", "n", "high", "low"]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    wide = "decimal(38,0)"
    sums = (
        map_batches(rows, task, "d int, n bigint, high bigint, low bigint")
        .groupBy("d")
        .agg(*[F.sum(F.col(c).cast(wide)).alias(c) for c in ("n", "high", "low")])
        .collect()
    )
    if not sums:
        return 0, []
    by_place = {r["d"]: (int(r["high"]) << LIMB) + int(r["low"]) for r in sums}
    return int(sums[0]["n"]), [by_place[d] for d in range(size)]


def _products(
    rows: DataFrame, size: int, width: int, values: Callable[[np.ndarray], np.ndarray]
) -> np.ndarray:
    """Sum over the rows of the outer product of ``values`` with itself."""

    def add(total: np.ndarray, batch: pa.RecordBatch) -> None:
        found = values(_integers(batch, size))
        total += found.T @ found

    return sum_matrices(rows, (width, width), add)


def fit(
    vectors: DataFrame,
    components: int = COMPONENTS,
    id_col: str = "vec_id",
    column: str = "embedding",
) -> Whitening:
    """Centre and components of all usable vectors of the commonest length.

    Vectors of another length (of equally common ones the longest counts) are
    left out here and in ``project``. No vectors, or only equal ones, give a
    model without components.
    """
    rows = usable(vectors, id_col, column)
    lengths = rows.groupBy(F.size("entries").alias("size")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    size = common["size"] if common else 0
    none = np.zeros(0)
    empty = Whitening(0, none, none, np.zeros((size, 0)), none, none)
    if not size:
        return empty
    rows = rows.filter(F.size("entries") == size)
    n, sums = _sums(rows, size)
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n for s in sums], dtype=np.int64)
    centre = Whitening(n, whole, rest, empty.components, none, none)
    covariance = _products(rows, size, size, lambda ys: _centred(centre, ys)) / n
    eigenvalues, vectors_ = leading_components(covariance, components)
    explained = eigenvalues / max(np.trace(covariance), np.finfo(float).tiny)
    model = Whitening(n, whole, rest, vectors_, eigenvalues, explained)
    found = len(eigenvalues)
    if not found:
        return model

    def with_ones(ys: np.ndarray) -> np.ndarray:
        return np.hstack([_whiten(model, ys), np.ones((len(ys), 1))])

    moments = _products(rows, size, found + 1, with_ones) / n
    means = moments[found, :found]
    error = moments[:found, :found] - np.outer(means, means) - np.eye(found)
    return Whitening(
        n, whole, rest, vectors_, eigenvalues, explained, float(np.abs(error).max())
    )


def _whiten(model: Whitening, ys: np.ndarray) -> np.ndarray:
    return _centred(model, ys) @ (model.components / np.sqrt(model.eigenvalues))


def deviations(model: Whitening, ys: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None beyond the long range."""
    if not len(ys):
        return []
    apart = ys - model.whole
    reach = (int(np.abs(apart).max()) + 1) * model.n
    if reach**2 * ys.shape[1] < 2**63:
        return ((model.n * apart - model.rest) ** 2).sum(axis=1).tolist()
    exact = [
        sum((model.n * int(a) - int(r)) ** 2 for a, r in zip(row, model.rest))
        for row in apart
    ]
    return [value if value < 2**63 else None for value in exact]


def project(
    vectors: DataFrame,
    model: Whitening,
    id_col: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """One row per usable vector and component.

    Dropped: null vectors, vectors with a null, non-finite or 2^56 and larger
    entry, vectors of another length than the model's. Repeated and null ids
    keep their rows. ``deviation`` is null where it does not fit a long.
    """
    size, found = model.components.shape
    rows = usable(vectors, id_col, column).filter(F.size("entries") == size)
    if not found:
        rows = rows.limit(0)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ys = _integers(batch, size)
            ids = batch.column(batch.schema.get_field_index("vec_id"))
            row = np.repeat(np.arange(len(ys)), found)
            total = len(row)
            columns = [
                ids.take(pa.array(row)),
                pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), len(ys))),
                pa.array(np.full(total, model.n)),
                pa.array(deviations(model, ys), pa.int64()).take(pa.array(row)),
                pa.array(_whiten(model, ys).ravel()),
                pa.array(np.tile(model.explained, len(ys))),
                pa.array(np.full(total, model.identity_error)),
            ]
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(rows, task, SCHEMA)
