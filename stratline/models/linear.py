"""Linear models from sums over the rows.

One scan gives the number of rows, sums and products of features and label for each fold.
What a model needs of its training rows is the total less the fold it leaves out, so all
folds, penalties and models share that scan. Least squares and ridge are a solve, the lasso
is coordinate descent on the products. The balanced logistic model takes Newton steps, each
one pass with the gradients and Hessians of all folds together.

Penalties refer to features scaled by their population standard deviation; a constant
feature gets no weight.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol,
    HasPredictionCol,
    HasProbabilityCol,
    HasRawPredictionCol,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

NEWTON_STEPS = 60


@dataclass
class Moments:
    """Of some rows: their number, means and covariances of features and (last) label."""

    n: float
    mean: np.ndarray
    cov: np.ndarray

    @property
    def sd(self) -> np.ndarray:
        return np.sqrt(np.maximum(np.diag(self.cov), 0))


def numbers(rows: DataFrame, features: Sequence[str], label: str, fold: str | None) -> DataFrame:
    """(v, fold): features and label of each row as one array."""
    values = [F.col(f"`{c}`").cast("double") for c in (*features, label)]
    return rows.select(F.array(*values).alias("v"), (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"))


def arrays(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    if np.isnan(values).any():
        raise ValueError("features and labels of a linear model must not be missing")
    return values, batch.column(1).to_numpy(zero_copy_only=False)


def summed(parts: DataFrame, shape: tuple[int, ...]) -> dict[int, np.ndarray]:
    """Sums of (key, slot, v) rows as an array for each key."""
    found = parts.groupBy("key", "slot").agg(F.sum("v").alias("v")).toArrow()
    out: dict[int, np.ndarray] = {}
    for key in np.unique(found.column("key").to_numpy()):
        own = found.column("key").to_numpy() == key
        flat = np.zeros(int(np.prod(shape)))
        flat[found.column("slot").to_numpy()[own]] = found.column("v").to_numpy()[own]
        out[int(key)] = flat.reshape(shape)
    return out


def emitted(total: Mapping[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for key, values in total.items():
        flat = values.reshape(-1)
        cols = [pa.array(np.full(len(flat), key)), pa.array(np.arange(len(flat))), pa.array(flat)]
        yield pa.RecordBatch.from_arrays(cols, names=["key", "slot", "v"])


PARTS = "key bigint, slot bigint, v double"


def gram(rows: DataFrame, features: Sequence[str], label: str, fold: str | None = None) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """A centre, and for each fold the products of (1, features - centre, label - centre)."""
    width = len(features) + 1
    flat = numbers(rows, features, label, fold)
    # Any point near the rows will do as centre; it keeps large values from cancelling.
    first = flat.first()
    centre = np.nan_to_num(np.array(first["v"], float)) if first else np.zeros(width)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            values, folds = arrays(batch, width)
            z = np.concatenate([np.ones((len(values), 1)), values - centre], 1)
            for k in np.unique(folds):
                own = z[folds == k]
                total[int(k)] = total.get(int(k), 0) + own.T @ own
        yield from emitted(total)

    return centre, summed(flat.mapInArrow(run, PARTS), (width + 1, width + 1))


def moments(centre: np.ndarray, sums: Mapping[int, np.ndarray], without: int | None = None) -> Moments:
    total = sum((m for k, m in sums.items() if k != without), np.zeros((len(centre) + 1,) * 2))
    n = total[0, 0]
    shift = total[0, 1:] / max(n, 1)
    return Moments(n, centre + shift, total[1:, 1:] / max(n, 1) - np.outer(shift, shift))


def solve(m: Moments, alpha: float = 0.0, l1: bool = False) -> tuple[np.ndarray, float]:
    """Coefficients and intercept."""
    sd = m.sd
    used = np.flatnonzero(sd[:-1] > 1e-12 * (1 + np.abs(m.mean[:-1])))
    corr = m.cov[np.ix_(used, used)] / np.outer(sd[used], sd[used])
    toward = m.cov[used, -1] / sd[used]
    if l1:
        w = lasso(corr, toward, alpha)
    elif alpha:
        w = np.linalg.solve(corr + alpha / max(m.n, 1) * np.eye(len(used)), toward)
    else:
        w = np.linalg.lstsq(corr, toward, rcond=1e-12)[0]
    out = np.zeros(len(sd) - 1)
    out[used] = w / sd[used]
    return out, float(m.mean[-1] - out @ m.mean[:-1])


def lasso(corr: np.ndarray, toward: np.ndarray, alpha: float) -> np.ndarray:
    """min |y - Xw|^2 / 2n + alpha |w|_1 by coordinate descent on the products."""
    w = np.zeros(len(toward))
    rest = toward.copy()  # toward - corr @ w
    for _ in range(100_000):
        moved = 0.0
        for j in range(len(w)):
            pull = rest[j] + corr[j, j] * w[j]
            new = np.sign(pull) * max(abs(pull) - alpha, 0.0) / corr[j, j]
            if new != w[j]:
                rest -= corr[:, j] * (new - w[j])
                moved, w[j] = max(moved, abs(new - w[j])), new
        if moved <= 1e-12 * (1 + np.abs(w).max(initial=0)):
            break
    return w


# --- logistic ---------------------------------------------------------------------------


def newton(
    rows: DataFrame, features: Sequence[str], label: str, cs: Sequence[float],
    fold: str | None = None, without: Sequence[int | None] = (None,),
) -> list[tuple[np.ndarray, float]]:
    """Coefficients and intercept of the balanced logistic model for each (C, fold left out).

    min sum w_i loss_i + |w|^2 / 2C, classes weighing the same in total. A step that does not
    lower the objective is halved."""
    centre, sums = gram(rows, features, label, fold)
    p, width = len(features), len(features) + 1
    plans = []
    for c, k in zip(cs, without):
        m = moments(centre, sums, k)
        up = m.n * m.mean[-1]
        weights = [m.n / (2 * x) if x > 0.5 else 0.0 for x in (m.n - up, up)]
        sd = np.where(m.sd[:-1] > 1e-12 * (1 + np.abs(m.mean[:-1])), m.sd[:-1], np.inf)
        plans.append((k, m.mean[:-1], sd, weights, np.append(np.full(p, 1 / c), 0.0)))
    flat = numbers(rows, features, label, fold)
    points = [np.zeros(width) for _ in plans]
    kept: list = [None] * len(plans)  # (objective, point, step) last taken
    open_ = set(range(len(plans)))
    for _ in range(NEWTON_STEPS):
        trial = {k: points[k] for k in open_}

        def run(batches: Iterable[pa.RecordBatch], trial=trial) -> Iterator[pa.RecordBatch]:
            total = {k: np.zeros((width + 1, width)) for k in trial}
            loss = dict.fromkeys(trial, 0.0)
            for batch in batches:
                values, folds = arrays(batch, width)
                for k, point in trial.items():
                    left, mean, sd, weights, _ = plans[k]
                    own = values if left is None else values[folds != left]
                    z = np.concatenate([(own[:, :-1] - mean) / sd, np.ones((len(own), 1))], 1)
                    y = own[:, -1]
                    w = np.where(y > 0.5, weights[1], weights[0])
                    margin = z @ point
                    chance = 1 / (1 + np.exp(-margin))
                    total[k][:-1] += (z * (w * chance * (1 - chance))[:, None]).T @ z
                    total[k][-1] += z.T @ (w * (chance - y))
                    loss[k] += float((w * (np.logaddexp(0, margin) - y * margin)).sum())
            yield from emitted({k: np.append(total[k].reshape(-1), loss[k]) for k in trial})

        found = summed(flat.mapInArrow(run, PARTS), ((width + 1) * width + 1,))
        for k in list(open_):
            penalty = plans[k][4]
            values = found.get(k, np.zeros((width + 1) * width + 1))
            objective = values[-1] + 0.5 * (penalty * points[k] ** 2).sum()
            if kept[k] is not None and objective > kept[k][0] + 1e-12 * abs(kept[k][0]):
                before, start, step = kept[k]
                step = step / 2
                kept[k], points[k] = (before, start, step), start - step
            else:
                matrix = values[:-1].reshape(width + 1, width)
                hessian = matrix[:-1] + np.diag(penalty)
                gradient = matrix[-1] + penalty * points[k]
                step = np.linalg.lstsq(hessian, gradient, rcond=1e-14)[0]
                kept[k] = (objective, points[k], step)
                points[k] = points[k] - step
            if np.abs(kept[k][2]).max(initial=0) < 1e-10 * (1 + np.abs(points[k]).max(initial=0)):
                open_.discard(k)
        if not open_:
            break
    out = []
    for (_, mean, sd, _, _), point in zip(plans, points):
        w = point[:-1] / sd
        out.append((w, float(point[-1] - w @ mean)))
    return out


# --- Spark ML stages --------------------------------------------------------------------


class _Linear(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsWritable, DefaultParamsReadable):
    """Coefficients kept as text in a parameter, so that the stage can be saved."""

    content = Param(Params._dummy(), "content", "coefficients and intercept", TypeConverters.toString)

    def __init__(self, found: tuple[np.ndarray, float] | None = None, **columns):
        super().__init__()
        if found is not None:
            self._set(content=json.dumps([found[0].tolist(), found[1]]))
        self._set(**columns)

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(json.loads(self.getOrDefault(self.content))[0])

    @property
    def intercept(self) -> float:
        return json.loads(self.getOrDefault(self.content))[1]

    def margin(self) -> Column:
        weights = F.from_json(F.lit(json.dumps(self.coefficients.toArray().tolist())), "array<double>")
        terms = F.zip_with(vector_to_array(F.col(self.getFeaturesCol())), weights, lambda x, w: x * w)
        return F.aggregate(terms, F.lit(self.intercept), lambda total, t: total + t)


class LinearModel(_Linear):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getPredictionCol(), self.margin())


class LogisticModel(_Linear, HasProbabilityCol, HasRawPredictionCol):
    def _transform(self, df: DataFrame) -> DataFrame:
        p = 1 / (1 + F.exp(-self.margin()))
        return df.withColumns(
            {
                self.getRawPredictionCol(): array_to_vector(F.array(-self.margin(), self.margin())),
                self.getProbabilityCol(): array_to_vector(F.array(1 - p, p)),
                self.getPredictionCol(): (p > 0.5).cast("double"),
            }
        )
