"""Whitening of embeddings on eigenvectors refined in mixed precision.

Entries are put on an integer grid, x = floor(1024 * c) + 100000, so that sums, covariance
and deviations are exact whatever the order in which Spark adds them. One pass gives the
sums, a second the products of entries centred at the whole part of their mean; both are
Spark aggregates of per-partition totals, and what reaches the driver is one row for each
pair of dimensions. Eigenvectors start in single precision and are corrected by the
matrix-multiplication iteration of Ogita and Aishima in extended precision: with
R = I - X'X and S = X'AX, X takes the step X E, E_ij = (S_ij + l_j R_ij) / (l_j - l_i). Where
two eigenvalues are closer than the present error that step is undefined: such a cluster is
only made orthogonal, and then its own small shifted problem is solved, which turns it.

Rows whose vector is null, empty or holds null or non-finite entries are left out, as are
vectors of another length than the most frequent one (the longer one in a tie). Repeated
rows and null ids stay, each with its own result. Entries beyond 2**36 in size are held at
that bound. A deviation too large for a long is null. Components without variance (equal
rows, fewer rows than dimensions) have null scores; `explained` is null without any
variance, identity_error is taken over the components that have scores. An empty table
gives an empty result. Other columns are not looked at; vectors of any length are a row's
own matter, memory grows with the square of the dimension.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

# The grid of the entries.
SCALE, SHIFT = 1024, 100_000
LIMIT = 1 << 46
WIDE = np.longdouble

SCHEMA = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def vectors(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, rows, x) of the usable vectors of a batch, by their length."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = pc.fill_null(column.values, float("nan")).to_numpy(zero_copy_only=False)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    size = np.diff(offsets)
    usable = column.is_valid().to_numpy(zero_copy_only=False) & (bad[offsets[1:]] == bad[offsets[:-1]]) & (size > 0)
    for dim in np.unique(size[usable]):
        rows = np.flatnonzero(usable & (size == dim))
        c = values[offsets[rows][:, None] + np.arange(dim)]
        yield int(dim), rows, np.clip(np.floor(c * SCALE), -LIMIT, LIMIT).astype(np.int64) + SHIFT


def of_dimension(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    for found, rows, x in vectors(batch.column(1)):
        if found == dim:
            return rows, x
    return np.zeros(0, np.int64), np.zeros((0, dim), np.int64)


def exact(values: Iterable[int]) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def sums(rows: DataFrame) -> DataFrame:
    """(dim, place, n, s): exact sums of every dimension, for each length of vector."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, found, x in vectors(batch.column(1)):
                n = np.full(dim, len(found), np.int64)
                cols = [pa.array(np.full(dim, dim, np.int32)), pa.array(np.arange(dim, dtype=np.int32)), pa.array(n), exact(x.sum(0))]
                yield pa.RecordBatch.from_arrays(cols, names=["dim", "place", "n", "s"])

    found = rows.mapInArrow(run, "dim int, place int, n bigint, s decimal(38,0)")
    return found.groupBy("dim", "place").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s"))


def products(y: np.ndarray) -> np.ndarray:
    """y'y in whole numbers of any size: matrix products in double precision of parts so
    small that every sum is exact."""
    top = int(np.abs(y).max(initial=0))
    if top > 1 << 20:
        high, low = y >> 23, y & ((1 << 23) - 1)
        both = products_of(high, low)
        return (products_of(high, high) << 46) + ((both + both.T) << 23) + products_of(low, low)
    return products_of(y, y)


def products_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    top = max(int(np.abs(a).max(initial=1)) * int(np.abs(b).max(initial=1)), 1)
    step = max(1, (1 << 53) // top)
    out = np.zeros((a.shape[1], b.shape[1]), object)
    for at in range(0, len(a), step):
        part = a[at : at + step].astype(float).T @ b[at : at + step].astype(float)
        out += part.astype(np.int64).astype(object)
    return out


def pairs(rows: DataFrame, dim: int, values: Callable[[pa.RecordBatch], np.ndarray], whole: bool) -> dict[tuple[int, int], object]:
    """Sum over all rows of the product of every two of their values, exact if whole."""
    kind = "decimal(38,0)" if whole else "double"
    left, right = np.triu_indices(dim)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim), object if whole else float)
        for batch in batches:
            v = values(batch)
            total = total + (products(v) if whole else v.T @ v)
        found = total[left, right]
        cols = [pa.array(left.astype(np.int32)), pa.array(right.astype(np.int32)), exact(found) if whole else pa.array(found)]
        yield pa.RecordBatch.from_arrays(cols, names=["i", "j", "v"])

    partial = rows.mapInArrow(run, f"i int, j int, v {kind}")
    total = partial.groupBy("i", "j").agg(F.sum("v").cast(kind).alias("v"))
    return {(r.i, r.j): r.v for r in total.collect()}  # dim * (dim + 1) / 2 rows


def refined(a: np.ndarray, steps: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and their eigenvectors (columns) of a symmetric matrix, to about
    the precision of its type, which is wider than double."""
    size = np.abs(a).max(initial=0) or WIDE(1)
    a = a / size
    one = np.eye(len(a), dtype=WIDE)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    norm = WIDE(np.linalg.norm(a.astype(float), 2))
    floor = 4 * len(a) * np.finfo(WIDE).eps * norm
    for step in range(steps):
        r = one - x.T @ x
        s = x.T @ a @ x
        r, s = (r + r.T) / 2, (s + s.T) / 2  # else rounding over a small gap spoils the angles
        values = np.diag(s) / (1 - np.diag(r))
        error = WIDE(np.linalg.norm((s - np.diag(values)).astype(float), 2)) + norm * WIDE(np.linalg.norm(r.astype(float), 2))
        if error <= floor:
            break
        # Steps stay small (an eighth at most), so that the error falls with its square.
        parts = clusters(values, 8 * error)
        own = np.zeros(len(a), np.int64)
        for k, part in enumerate(parts):
            own[part] = k
        near = own[:, None] == own[None, :]
        gap = np.where(near, 1, values[None, :] - values[:, None])
        x = x + x @ np.where(near, r / 2, (s + values * r) / gap)
        x = solved_clusters(a, x, values, parts)
    order = np.argsort(-values, kind="stable")
    return values[order] * size, x[:, order]


def clusters(values: np.ndarray, width: WIDE) -> list[np.ndarray]:
    """Runs of eigenvalues with gaps up to width."""
    order = np.argsort(values, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(values[order]) > width) + 1)


def solved_clusters(a: np.ndarray, x: np.ndarray, values: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    """Every cluster is turned by the eigenvectors of its own shifted matrix, whose entries
    are small, so that double precision tells its eigenvalues apart."""
    for part in parts:
        if len(part) > 1:
            own = x[:, part]
            shift = values[part].mean()
            small = own.T @ (a @ own) - shift * (own.T @ own)
            scale = np.abs(small).max()
            if scale > 0:
                turn = np.linalg.eigh(((small + small.T) / (2 * scale)).astype(float))[1].astype(WIDE)
                # The turn itself is orthogonal to double precision only.
                turn = turn @ (3 * np.eye(len(part), dtype=WIDE) - turn.T @ turn) / 2
                x[:, part] = own @ turn
    return x


@dataclass(frozen=True)
class Whitener:
    """What every row needs: sums, the whole part of the means, and the scaled components."""

    dim: int
    n: int
    middle: np.ndarray  # whole part of the means
    rest: np.ndarray  # sums of x - middle, modulo 2**64
    offset: np.ndarray  # means of x - middle
    axes: np.ndarray  # a column for each component with variance
    explained: tuple[float | None, ...]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.middle) - self.offset) @ self.axes

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Exact sums of (n * x - S) ** 2; null beyond a long. Where the sum fits a long it is
        right modulo 2**64, whatever its parts do."""
        y = x - self.middle
        rough = ((y.astype(float) - self.offset) ** 2).sum(1) * float(self.n) ** 2
        with np.errstate(over="ignore"):
            part = y * np.int64(self.n) - self.rest
            out = (part * part).sum(1)
        fits = rough < 9.2e18
        for k in np.flatnonzero((rough >= 9.2e18) & (rough < 9.3e18)):
            rest = [int(v) for v in self.rest]
            fits[k] = sum((self.n * int(v) - r) ** 2 for v, r in zip(y[k], rest)) < 1 << 63
        return pa.array(out, mask=~fits)


def whole_means(n: int, total: list[int]) -> tuple[np.ndarray, list[int]]:
    middle = [s // n for s in total]
    return np.array(middle, np.int64), [s - n * m for s, m in zip(total, middle)]


def covariance(n: int, rest: list[int], found: dict[tuple[int, int], Decimal]) -> np.ndarray:
    """Covariance from exact products: only the last division is rounded."""
    dim = len(rest)
    out = np.zeros((dim, dim), WIDE)
    below = WIDE(str(n * n))
    for (i, j), v in found.items():
        out[i, j] = out[j, i] = WIDE(str(n * int(v) - rest[i] * rest[j])) / below
    return out


def fit(rows: DataFrame, components: int) -> Whitener | None:
    """Of (id, vector) rows; None if there is no usable vector."""
    found = sums(rows)
    # Vectors of one length only: the rows fetched are their dimensions.
    top = found.where("place = 0").orderBy(F.desc("n"), F.desc("dim")).first()
    if top is None:
        return None
    dim, n = top["dim"], top["n"]
    total = [int(r.s) for r in found.where(F.col("dim") == dim).orderBy("place").collect()]
    middle, rest = whole_means(n, total)
    v = covariance(n, rest, pairs(rows, dim, lambda batch: of_dimension(batch, dim)[1] - middle, True))
    values, x = refined(v)
    trace = np.trace(v)
    least = np.abs(v).max(initial=0) * dim * WIDE(2) ** -58
    shown = min(components, dim)
    used = [k for k in range(shown) if values[k] > least]
    axes = np.zeros((dim, len(used)))
    for column, k in enumerate(used):
        # One sign for all rows: the largest entry is positive.
        sign = 1 if x[np.abs(x[:, k]).argmax(), k] >= 0 else -1
        axes[:, column] = (sign * x[:, k] / np.sqrt(values[k])).astype(float)
    explained = tuple(float(max(values[k], 0) / trace) if trace > 0 else None for k in range(shown))
    offset = np.array([float(WIDE(str(r)) / n) for r in rest])
    wrapped = np.array([r % (1 << 64) for r in rest], np.uint64).view(np.int64)
    return Whitener(dim, n, middle, wrapped, offset, axes, explained)


def identity_error(rows: DataFrame, model: Whitener) -> float | None:
    """Largest absolute entry of the covariance of the scores minus the identity, measured
    on the scores of all rows; their own means are taken out too."""
    k = model.axes.shape[1]
    if not k:
        return None

    def with_one(batch: pa.RecordBatch) -> np.ndarray:
        z = model.scores(of_dimension(batch, model.dim)[1])
        return np.concatenate([np.ones((len(z), 1)), z], 1)

    found = pairs(rows, k + 1, with_one, False)
    n = found[0, 0]
    entries = (found[i, j] / n - found[0, i] / n * (found[0, j] / n) - (i == j) for i in range(1, k + 1) for j in range(i, k + 1))
    return float(max(abs(e) for e in entries))


def whiten(embeddings: DataFrame, components: int = 8) -> DataFrame:
    """One row for each usable row of (vec_id, embedding) and each of the first components:
    n, deviation from the mean, score on the component, share of the variance."""
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    model = fit(rows, components)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], SCHEMA)
    wrong = identity_error(rows, model)
    shown = len(model.explained)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, x = of_dimension(batch, model.dim)
            k = np.repeat(np.arange(len(found)), shown)
            score = np.full((len(found), shown), np.nan)
            score[:, : model.axes.shape[1]] = model.scores(x)
            flat = score.reshape(-1)
            cols = [
                batch.column(0).take(pa.array(found[k])),
                pa.array(np.tile(np.arange(1, shown + 1, dtype=np.int32), len(found))),
                pa.array(np.full(len(k), model.n)),
                model.deviations(x).take(pa.array(k)),
                pa.array(flat, mask=np.isnan(flat)),
                pa.array(list(model.explained) * len(found), pa.float64()),
                pa.array([wrong] * len(k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, SCHEMA)
