"""Linear learners of all folds at once, from sums over the rows.

Ridge: sums of products per fold come from one aggregation; what a fold's
learner needs is the total less the fold, and its coefficients solve a small
system. Logistic: Newton steps; one pass adds up gradients and Hessians of all
learners, whose weights of a row may differ.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.operators.boosting import _matrix, _plain
from loanloom.schema import TARGET_COL
from loanloom.session import write_table

#: Newton stops when the largest fall that a step promises is below this, per unit of weight.
TOLERANCE = 1e-13
STEPS = 60


def linear_score(cols: Sequence[str], coefficients: Sequence[float], intercept: float) -> Column:
    out = F.lit(float(intercept))
    for c, b in zip(cols, coefficients, strict=True):
        out = out + F.col(c) * F.lit(float(b))
    return out


def fold_moments(rows: DataFrame, cols: Sequence[str], label: str = TARGET_COL, fold: str = "fold_id") -> dict[int, np.ndarray]:
    """Per fold the sums of all products of (1, columns, label), as a square matrix; one aggregation."""
    names = [F.lit(1.0), *[F.col(c).cast("double") for c in cols], F.col(label).cast("double")]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    out = {}
    for r in rows.groupBy(fold).agg(*[F.sum(names[i] * names[j]).alias(f"m{i}_{j}") for i, j in pairs]).collect():
        m = np.zeros((len(names), len(names)))
        for i, j in pairs:
            m[i, j] = m[j, i] = r[f"m{i}_{j}"] or 0.0
        out[r[fold]] = m
    return out


def ridge_of_moments(m: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of least squares with ``alpha`` times the sum of squared coefficients."""
    n = m[0, 0]
    if not n:
        raise ValueError("no rows to learn from")
    mean = m[0, 1:] / n
    centred = m[1:, 1:] - n * np.outer(mean, mean)
    k = len(mean) - 1
    beta = np.linalg.solve(centred[:k, :k] + alpha * np.eye(k), centred[:k, k])
    return beta, float(mean[k] - mean[:k] @ beta)


def ridge_folds(rows: DataFrame, cols: Sequence[str], alpha: float = 1.0, label: str = TARGET_COL
                ) -> dict[int, tuple[np.ndarray, float]]:
    """fold -> (coefficients, intercept) of the learner of all other folds."""
    moments = fold_moments(rows, cols, label)
    total = sum(moments.values())
    return {k: ridge_of_moments(total - m, alpha) for k, m in sorted(moments.items())}


def _newton_sums(betas: np.ndarray):
    """(y, weights, x) -> (cell, value): loss, gradient and Hessian of each learner, summed over a task."""
    n_models, d = betas.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((n_models, 1 + d + d * d))
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            y, w = batch.column(0).to_numpy(), _matrix(batch.column(1), n)
            x = np.c_[np.ones(n), _matrix(batch.column(2), n)]
            for m in range(n_models):
                used = w[:, m] > 0
                if not used.any():
                    continue
                xs, ws, ys = x[used], w[used, m], y[used]
                z = xs @ betas[m]
                p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
                out[m, 0] += (ws * np.logaddexp(0, np.where(ys > 0, -z, z))).sum()
                out[m, 1:1 + d] += xs.T @ (ws * (p - (ys > 0)))
                out[m, 1 + d:] += ((xs * (ws * p * (1 - p))[:, None]).T @ xs).ravel()
        flat = out.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], ["cell", "value"])

    return run


def logistic_fits(rows: DataFrame, features: Column, weights: Sequence[Column], penalty: float, label: str = TARGET_COL
                  ) -> list[tuple[np.ndarray, float]]:
    """(coefficients, intercept) of a learner for each weight column; a weight of 0 or null leaves a row out.

    Each minimises the weighted log loss plus ``penalty`` / 2 times the squared
    coefficients, the intercept free. ``features`` is an array of doubles. One
    pass over the rows serves a step of all learners; steps are halved until
    the loss falls.
    """
    w = F.array(*[F.coalesce(c.cast("double"), F.lit(0.0)) for c in weights])
    path = write_table(rows.select(F.col(label).cast("double").alias("y"), w.alias("w"), features.alias("x")))
    table = _plain(rows.sparkSession).read.schema("y double, w array<double>, x array<double>").parquet(path)
    first = table.agg(F.max(F.size("x")), *[F.sum(F.col("w")[m]) for m in range(len(weights))],
                      *[F.sum(F.when(F.col("y") > 0, F.col("w")[m])) for m in range(len(weights))]).first()
    if not first[0]:
        raise ValueError("no rows to learn from")
    d, n_models = first[0] + 1, len(weights)
    total = np.array([first[1 + m] or 0.0 for m in range(n_models)])
    if (total == 0).any():
        raise ValueError("a learner has no rows")
    share = np.clip([(first[1 + n_models + m] or 0.0) / total[m] for m in range(n_models)], 1e-9, 1 - 1e-9)
    held = np.full(d, penalty)
    held[0] = 0.0
    best = np.zeros((n_models, d))
    best[:, 0] = np.log(share / (1 - share))
    step, tried = np.zeros((n_models, d)), best.copy()
    state: list[tuple[float, np.ndarray, np.ndarray]] = []
    size = np.ones(n_models)
    open_ = np.ones(n_models, bool)
    for _ in range(STEPS):
        found = table.mapInArrow(_newton_sums(tried), "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
        sums = np.zeros(n_models * (1 + d + d * d))
        sums[found.column(0).to_numpy()] = found.column(1).to_numpy()
        sums = sums.reshape(n_models, -1)
        for m in np.flatnonzero(open_):
            loss = sums[m, 0] + 0.5 * held @ tried[m] ** 2
            if len(state) > m and not loss <= state[m][0] + 1e-12 * abs(state[m][0]):
                size[m] /= 2
                open_[m] = size[m] > 1e-6
                tried[m] = best[m] + size[m] * step[m]
                continue
            gradient = sums[m, 1:1 + d] + held * tried[m]
            hessian = sums[m, 1 + d:].reshape(d, d) + np.diag(held)
            entry = (loss, gradient, hessian)
            if len(state) > m:
                state[m] = entry
            else:
                state.append(entry)
            best[m] = tried[m]
            step[m] = -np.linalg.lstsq(hessian, gradient, rcond=None)[0]
            size[m] = 1.0
            if -gradient @ step[m] / 2 <= TOLERANCE * total[m]:
                # the last step costs nothing more and squares what is left of the error
                best[m] = best[m] + step[m]
                open_[m] = False
            tried[m] = best[m] + (step[m] if open_[m] else 0.0)
        if not open_.any():
            break
    return [(b[1:].copy(), float(b[0])) for b in best]


class LinearModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted logistic learner; adds ``probability`` to rows with a feature vector, by JVM expressions."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector of features", TypeConverters.toString)
    fitted = Param(Params._dummy(), "fitted", "coefficients and intercept as JSON", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(featuresCol="features", fitted="{}")

    @classmethod
    def of(cls, coefficients: Sequence[float], intercept: float, features: str = "features") -> LinearModel:
        return cls()._set(fitted=json.dumps({"coefficients": [float(b) for b in coefficients], "intercept": intercept}), featuresCol=features)

    @property
    def coefficients(self) -> np.ndarray:
        return np.array(json.loads(self.getOrDefault(self.fitted))["coefficients"])

    @property
    def intercept(self) -> float:
        return json.loads(self.getOrDefault(self.fitted))["intercept"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        products = F.zip_with(vector_to_array(self.getOrDefault(self.featuresCol)), F.array(*[F.lit(float(b)) for b in self.coefficients]),
                              lambda x, b: x * b)
        z = F.aggregate(products, F.lit(self.intercept), lambda a, b: a + b)
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
        return dataset.withColumn("probability", array_to_vector(F.array(1.0 - p, p)))


# task functions travel with the job, so executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
