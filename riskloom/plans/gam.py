"""Penalised logistic fit of spline terms by iteratively reweighted least squares.

Maximises the weighted log likelihood less half of ``b'Pb``. For a spline term ``P`` holds
the squared second differences of neighbouring coefficients, which leaves straight lines
unpenalised; for every other coefficient its square; the intercept is free. An iteration is
one pass: every Arrow batch becomes ``X'WX`` and ``X'Wz`` of its rows, Spark sums these, and
the driver solves a system as wide as the model, some 60 columns. So what leaves a task or
comes to the driver depends on the columns only.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# the batch function below travels whole: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# weight of the penalties: a fixed value
SMOOTHING = 0.6
# every block of a spline basis sums to one, as the intercept does: this much on the
# diagonal picks one of the equal fits
RIDGE = 1e-7
TOLERANCE = 1e-9
HALVINGS = 30


def penalty(size: int, splines: list[int], smoothing: float = SMOOTHING) -> np.ndarray:
    """``P`` for spline blocks of the given widths, other coefficients, and the intercept."""
    out = np.zeros((size + 1, size + 1))
    at = 0
    for width in splines:
        second = np.diff(np.eye(width), 2, axis=0)
        out[at : at + width, at : at + width] = second.T @ second
        at += width
    out[range(at, size), range(at, size)] = 1.0
    return smoothing * out


def _sums(beta: np.ndarray):
    """Per batch: the upper system, its right side and the log likelihood, as one array."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for frame in frames:
            if not len(frame):
                continue
            x = np.column_stack([np.stack(frame["x"].to_numpy()), np.ones(len(frame))])
            y, weight = frame["label"].to_numpy("float64"), frame["weight"].to_numpy("float64")
            eta = x @ beta
            mean = 1 / (1 + np.exp(-np.clip(eta, -700, 700)))
            w = weight * mean * (1 - mean)
            # X'Wz with z = eta + (y - mean) / (mean (1 - mean)), without the division
            right = x.T @ (w * eta + weight * (y - mean))
            likelihood = (weight * (y * eta - np.logaddexp(0, eta))).sum()
            part = np.concatenate([((x.T * w) @ x).ravel(), right, [likelihood]])
            total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total)), "v": total})

    return run


def _system(rows: DataFrame, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    n = len(beta)
    found = rows.mapInPandas(_sums(beta), "i long, v double").groupBy("i").agg(F.sum("v").alias("v"))
    flat = np.zeros(n * n + n + 1)
    for row in found.collect():  # as wide as the model squared
        flat[row["i"]] = row["v"]
    return flat[: n * n].reshape(n, n), flat[n * n : -1], flat[-1]


@dataclass(frozen=True)
class Fit:
    coefficients: np.ndarray
    intercept: float
    rounds: int
    converged: bool


def fit_penalised(rows: DataFrame, splines: list[int], iterations: int = 1000) -> Fit:
    """Fit ``label`` on the vector ``features``, rows weighted by ``weight``. Runs jobs.

    ``rows`` should be a stored table: it is read once an iteration. A step that does not
    raise the penalised likelihood is halved.
    """
    arrays = rows.select(vector_to_array("features").alias("x"), "label", "weight")
    first = arrays.first()
    if first is None:
        raise ValueError("no rows to fit")
    size = len(first["x"])
    ridge = RIDGE * np.eye(size + 1)
    ridge[-1, -1] = 0.0
    p = penalty(size, splines) + ridge
    beta = np.zeros(size + 1)
    system, right, likelihood = _system(arrays, beta)
    value = likelihood - beta @ p @ beta / 2
    for i in range(1, iterations + 1):
        step = np.linalg.solve(system + p, right) - beta
        gradient = right - system @ beta - p @ beta
        if np.abs(gradient).max() <= TOLERANCE * max(1.0, np.abs(right).max()):
            return Fit(beta[:-1], float(beta[-1]), i, True)
        for _ in range(HALVINGS):
            tried = _system(arrays, beta + step)
            gained = tried[2] - (beta + step) @ p @ (beta + step) / 2
            if gained >= value - 1e-12 * abs(value):
                break
            step = step / 2
        beta, (system, right, _), value = beta + step, tried, gained
    return Fit(beta[:-1], float(beta[-1]), iterations, False)


def as_model(rows: DataFrame, fit: Fit) -> LogisticRegressionModel:
    """The fit as a Spark ML stage that scores and is stored like any other."""
    context = rows.sparkSession.sparkContext
    java = context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        "penalised-splines", _py2java(context, Vectors.dense(fit.coefficients)), fit.intercept
    )
    return LogisticRegressionModel(java)


def score_equations(scored: DataFrame, fit: Fit, splines: list[int]) -> DataFrame:
    """``slot, gradient``: derivative of the penalised likelihood by each coefficient.

    By column expressions, from ``features``, ``label``, ``weight`` and ``score`` alone;
    zero at the optimum. The last slot is the intercept.
    """
    size = len(fit.coefficients)
    beta = np.append(fit.coefficients, fit.intercept)
    pull = (penalty(size, splines) @ beta).tolist()
    rest = F.col("weight") * (F.col("label") - F.col("score"))
    x = F.concat(vector_to_array("features"), F.array(F.lit(1.0)))
    each = scored.select(rest.alias("r"), F.posexplode(x).alias("slot", "x"))
    sums = each.groupBy("slot").agg(F.sum(F.col("r") * F.col("x")).alias("s"))
    held = F.element_at(F.array(*[F.lit(v) for v in pull]), F.col("slot") + 1)
    return sums.select("slot", (F.col("s") - held).alias("gradient"))
