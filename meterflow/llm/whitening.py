"""Whitening of embeddings by FEAST contour integration.

Components are floor(scale * c), c as double. The fit list holds each distinct
vector once; its covariance (divisor n) is summed up from blocks, each centred
on its own mean before multiplying, whose counts, sums and moments are merged
pairwise by Chan's update. Only the merged dim x dim moment, of a size that
does not grow with the rows, comes to the driver.

The highest eigenvalues are found there by FEAST. Sylvester's law gives the
number of eigenvalues above any point: the negative pivots of a Bunch-Parlett
factorisation of the shifted matrix. Bisection by such counts cuts the upper end
of the spectrum into intervals of at most ``PER_INTERVAL`` eigenvalues, where
they can be told apart. In each, the projector onto the eigenvectors is the
integral of (zI - V)^-1 along a circle; Gauss-Legendre nodes make it a few
complex shifted solves on a block of vectors. Rayleigh-Ritz in the projected
block gives eigenpairs, the block is projected again until they stand still, and
the number found inside must equal the inertia count, else the block grows.

Whitened rows are the projections of x - mean, over sqrt(eigenvalue), in the
input's own partitions: no shuffle. One more pass over the fit list measures how
far their covariance is from the identity.

Defined results: a vector that is null, empty or holds null or non-finite
entries has no row. A null id stays, repeated rows give repeated results, and
all rows of one vector the same ones. Vectors of one length are fitted together,
those of another length for themselves (``MAX_LENGTHS`` lengths at most, else an
error). Components whose eigenvalue is nothing but rounding (1e-12 of the
largest one, or less) cannot be scaled and have no row, so equal vectors, or a
single one, give no rows. Equal eigenvalues keep any orthonormal basis of their
space, the same for all rows. Values beyond a long raise an error that says so.
Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, ship

COMPONENTS = 16
OFFSET = 1_000_000
NODES = 8
PER_INTERVAL = 8
MAX_LENGTHS = 64
MERGE_GROUPS = 32
LEAST = 1e-12
NARROW = 1e-10
LONG = 2**63 - 1
MOMENTS = "g int, n long, sums array<string>, moment binary"
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# ------------------------------------------------------------- moments


@dataclass
class Moments:
    """Count, sums and centred second moment of some vectors. ``sums`` are
    exact whole numbers for x, doubles for whitened values."""

    n: int
    sums: list
    moment: np.ndarray

    @staticmethod
    def of(block: np.ndarray) -> Moments:
        exact = block.dtype.kind == "i"
        sums = [int(s) for s in (block.astype(object).sum(axis=0) if exact and np.abs(block).max(initial=0) > 2**40 else block.sum(axis=0))] if exact else block.sum(axis=0).tolist()
        centred = block - np.asarray([s / len(block) for s in sums])
        return Moments(len(block), sums, centred.T @ centred)

    def add(self, other: Moments) -> Moments:
        n = self.n + other.n
        apart = np.asarray([b / other.n - a / self.n for a, b in zip(self.sums, other.sums)])
        moment = self.moment + other.moment + np.outer(apart, apart) * (self.n * other.n / n)
        return Moments(n, [a + b for a, b in zip(self.sums, other.sums)], moment)


def _block_moments(batches: Iterator[pa.RecordBatch], project: np.ndarray | None, mean: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """One row of moments for each task, of x or of its whitened values."""
    total = None
    for b in batches:
        if not b.num_rows:
            continue
        x = _matrix(b.column(0))
        part = Moments.of(x if project is None else (x - mean) @ project)
        total = part if total is None else total.add(part)
    if total is not None:
        yield _moment_rows([(TaskContext.get().partitionId() % MERGE_GROUPS, total)])


def _moment_rows(rows: list[tuple[int, Moments]]) -> pa.RecordBatch:
    cols = [
        pa.array([g for g, _ in rows], pa.int32()), pa.array([m.n for _, m in rows], pa.int64()),
        pa.array([[repr(s) for s in m.sums] for _, m in rows], pa.list_(pa.string())), pa.array([m.moment.tobytes() for _, m in rows], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(cols, names=["g", "n", "sums", "moment"])


def _merged(rows: pa.Table, kind: type) -> Moments | None:
    total = None
    for n, sums, moment in zip(*(rows.column(c).to_pylist() for c in ("n", "sums", "moment"))):
        part = Moments(n, [kind(s) for s in sums], np.frombuffer(moment).reshape(len(sums), len(sums)))
        total = part if total is None else total.add(part)
    return total


def _moments(fit: DataFrame, project: np.ndarray | None = None, mean: np.ndarray | None = None) -> Moments | None:
    """Merged in two levels of tasks; one row comes to the driver."""
    kind = int if project is None else float

    def merge(rows: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_moment_rows([(rows.column("g")[0].as_py(), _merged(rows, kind))])])

    parts = fit.mapInArrow(lambda it: _block_moments(it, project, mean), MOMENTS)
    some = parts.groupBy("g").applyInArrow(merge, MOMENTS)
    one = some.withColumn("g", F.lit(0)).groupBy("g").applyInArrow(merge, MOMENTS)
    return _merged(one.toArrow(), kind)


# ------------------------------------------------------------- eigenvalues


def negative_pivots(a: np.ndarray) -> int:
    """The number of negative eigenvalues of a symmetric matrix, as pivots of
    its Bunch-Parlett factorisation (1x1 and 2x2 pivots, complete pivoting)."""
    a, found = a.copy(), 0
    alpha = (1 + 17**0.5) / 8
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        i = int(diagonal.argmax())
        off = np.abs(np.tril(a, -1))
        r, c = np.unravel_index(int(off.argmax()), off.shape)
        if diagonal[i] == 0 and off[r, c] == 0:
            break
        at = [i] if diagonal[i] >= alpha * off[r, c] else [int(r), int(c)]
        pivot = a[np.ix_(at, at)]
        # a 2x2 pivot has one eigenvalue of each sign, as its off-diagonal outweighs its diagonal
        found += int(pivot[0, 0] < 0) if len(at) == 1 else 1
        rest = np.delete(np.arange(len(a)), at)
        cross = a[np.ix_(rest, at)]
        a = a[np.ix_(rest, rest)] - cross @ np.linalg.solve(pivot, cross.T)
        a = (a + a.T) / 2
    return found


def count_above(v: np.ndarray, point: float) -> int:
    """How many eigenvalues are larger than ``point``."""
    return negative_pivots(point * np.eye(len(v)) - v)


def intervals(v: np.ndarray, wanted: int, per: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside), from the top down, that hold at least
    the ``wanted`` highest eigenvalues above the floor of rounding; an interval
    holds more than ``per`` only where bisection cannot tell them apart."""
    size = float(np.abs(v).sum(axis=1).max())  # Gershgorin: none is larger
    floor, high, above = LEAST * size, size * (1 + 1e-9), 0
    total = count_above(v, floor)
    out = []
    while above < min(wanted, total):
        low, inside = floor, total - above
        if inside > per:
            left, right, best = floor, high, None
            while right - left > NARROW * size and (best is None or best[1] <= per // 2 and right - left > 0.1 * (high - left)):
                mid = (left + right) / 2
                n = count_above(v, mid) - above
                if n > per:
                    left = mid
                else:
                    right = mid
                    best = (mid, n) if n else best
            if best is None:  # a cluster: the end stays clear of it
                left -= NARROW * size
                best = (left, count_above(v, left) - above)
            low, inside = best
        # the upper end comes down to its highest eigenvalue, away from those above
        left, right = low, high
        for _ in range(8):
            mid = (left + right) / 2
            left, right = (mid, right) if count_above(v, mid) > above else (left, mid)
        out.append((low, right, inside))
        high, above = low, above + inside
    return out


def feast(v: np.ndarray, low: float, high: float, count: int, nodes: int = NODES, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenpairs in (low, high], by falling eigenvalue."""
    dim, size = len(v), np.linalg.norm(v)
    at, weight = np.polynomial.legendre.leggauss(nodes)
    mid, radius = (low + high) / 2, (high - low) / 2
    turn = np.exp(0.5j * np.pi * (at + 1))  # the upper half circle; the lower one is its conjugate
    shifted = [(mid + radius * t) * np.eye(dim) - v for t in turn]
    width = min(dim, count + count // 2 + 2)
    while True:
        block, still = np.random.default_rng(dim).standard_normal((dim, width)), False
        for _ in range(rounds):
            # (1 / 2 pi i) times the integral; dz = i radius turn dphi, dphi = pi/2 at each node
            projected = sum(w / 2 * radius * np.real(t * np.linalg.solve(z, block)) for w, t, z in zip(weight, turn, shifted))
            basis, _ = np.linalg.qr(projected)
            values, small = np.linalg.eigh(basis.T @ v @ basis)
            vectors = basis @ small
            apart = np.linalg.norm(v @ vectors - vectors * values, axis=0)
            # directions that the projector has left as noise give Ritz values inside, too, but far from solutions
            inside = np.flatnonzero((values > low) & (values <= high))
            found = inside[np.argsort(apart[inside], kind="stable")[:count]]
            if still:  # one round beyond the last needed: all that doubles hold
                break
            still = len(found) == count and (apart[found] <= 1e-14 * size * dim**0.5).all()
            block = vectors
        if still or width == dim:
            break
        width = min(dim, 2 * width)
    if len(found) != count:  # all dimensions are spanned: the ends are eigenvalues but for rounding
        found = np.argsort(np.maximum(low - values, values - high), kind="stable")[:count]
    order = found[np.argsort(-values[found], kind="stable")]
    return values[order], vectors[:, order]


def top_eigenpairs(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Highest eigenvalues, falling, and their unit eigenvectors as columns."""
    if not np.abs(v).max(initial=0):
        return np.zeros(0), np.zeros((len(v), 0))
    pairs = [feast(v, *i) for i in intervals(v, wanted)]
    values, vectors = np.concatenate([p[0] for p in pairs]), np.hstack([p[1] for p in pairs])
    # neighbours in different intervals are orthogonal to the size of their residuals over their gap; make it exact
    vectors, r = np.linalg.qr(vectors)
    return values[:wanted], (vectors * np.sign(np.diagonal(r)))[:, :wanted]


# ------------------------------------------------------------- rows


@dataclass
class Whitening:
    n: int
    sums: list[int]  # of floor(scale * c), without the offset
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.asarray([s / self.n for s in self.sums])

    @property
    def project(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact."""
        most = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        if most**2 * x.shape[1] <= LONG:
            return ((self.n * x - np.asarray(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        out = [sum((self.n * int(c) - s) ** 2 for c, s in zip(row, self.sums)) for row in x]
        if max(out) > LONG:
            raise ValueError("a deviation does not fit a long")
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _usable(vector: Column) -> Column:
    """Not null, not empty, all entries there and finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & finite


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """vec_id and x, floor(scale * c) as longs without the offset."""
    as_doubles = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    x = F.transform("v", lambda c: F.floor(c * F.lit(scale)).cast("long"))
    return as_doubles.filter(_usable(F.col("v"))).select("vec_id", x.alias("x"))


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """From a table of distinct vectors ``x`` of one length; None if empty."""
    got = _moments(distinct)
    if got is None:
        return None
    v = got.moment / got.n
    values, vectors = top_eigenpairs(v, components)
    model = Whitening(got.n, got.sums, values, vectors, float(np.trace(v)))
    if len(values):
        white = _moments(distinct, model.project, model.mean)
        model.identity_error = float(np.abs(white.moment / white.n - np.eye(len(values))).max())
    return model


def _whitened(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    k = len(model.values)
    explained = model.values / model.trace
    mean, project = model.mean, model.project
    for b in batches:
        for at in range(0, b.num_rows, 4096):
            part = b.slice(at, 4096)
            x = _matrix(part.column(1))
            white = (x - mean) @ project
            ids = part.column(0).take(pa.array(np.repeat(np.arange(len(x)), k)))
            cols = [
                ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, model.n)),
                pa.array(np.repeat(np.asarray(model.deviations(x), np.int64), k)), pa.array(white.ravel()), pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(x) * k, model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0, components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: vec_id, component (from 1), n (distinct
    vectors), deviation, whitened, explained, identity_error. The offset of x
    cancels in all of them and is left out (n x - S and x - S / n)."""
    spark = vectors.sparkSession
    ship(spark)
    rows = whole_vectors(vectors, id_col, vector_col, scale)
    # map-side distinct first: copies of one vector meet in one row before the shuffle
    distinct = keep(rows.select("x").distinct(), "distinct-vectors")
    lengths = [r["d"] for r in distinct.select(F.size("x").alias("d")).distinct().limit(MAX_LENGTHS + 1).collect()]
    if len(lengths) > MAX_LENGTHS:
        raise ValueError(f"vectors of more than {MAX_LENGTHS} lengths")
    out = spark.createDataFrame([], RESULT)
    for d in sorted(lengths):
        one = F.size("x") == d if len(lengths) > 1 else F.lit(True)
        model = fit(distinct.filter(one), components)
        if len(model.values):
            out = out.unionByName(rows.filter(one).mapInArrow(lambda it, m=model: _whitened(it, m), RESULT))
    return out
