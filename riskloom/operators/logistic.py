"""Logistic regression by Newton steps, each of them one aggregate over all rows.

The loss of a penalised fit is convex, so a few steps reach its one minimum.  What a step needs from the rows are
sums: the loss, the gradient and the upper half of the Hessian, 28 numbers for five inputs.  They are combined in
every task before the shuffle, so a job moves one row per task and the driver solves one small linear system;
neither depends on how many rows there are, or on how they are spread.

A step that does not lower the loss is halved, which makes the fit safe from any start, also where the labels can be
told apart and plain Newton steps overshoot.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a step promises to take from the loss, as a share of it.  Near the minimum a step leaves an error of about its
# square, so the last one is taken without looking again.
TOLERANCE = 1e-14
MAX_PASSES = 100
# A step of which not even this much lowers the loss is rounding.
LEAST_SHARE = 1e-4


@dataclass(frozen=True)
class Fit:
    """Weights per input, the intercept, and how many passes over the rows it took."""

    weights: list[float]
    intercept: float
    passes: int


@dataclass(frozen=True)
class _Point:
    at: np.ndarray
    loss: float
    gradient: np.ndarray
    hessian: np.ndarray


def _sums(rows: DataFrame, names: list[str], at: np.ndarray):
    """Loss, gradient and Hessian of the weighted log loss at the given weights; the last one is the intercept."""
    score = F.lit(float(at[-1]))
    for name, weight in zip(names, at, strict=False):
        score = score + F.lit(float(weight)) * F.col(name)
    # Written for either sign of the score, and apart for both labels: nothing overflows, and what a chance close to 1
    # lacks keeps all its digits.
    small, positive = F.exp(-F.abs("score")), F.col("score") >= 0
    less, more = F.col("small") / (1 + F.col("small")), 1 / (1 + F.col("small"))
    miss = F.when(F.col("y") == 1, -F.when(positive, less).otherwise(more)).otherwise(
        F.when(positive, more).otherwise(less)
    )
    loss = F.greatest("score", F.lit(0.0)) - F.col("score") * F.col("y") + F.log1p("small")
    judged = (
        rows.withColumn("score", score)
        .withColumn("small", small)
        .withColumns({"loss": F.col("w") * loss, "slope": F.col("w") * miss, "bend": F.col("w") * less * more})
    )
    terms = [*map(F.col, names), F.lit(1.0)]
    upper = [(i, j) for i in range(len(terms)) for j in range(i, len(terms))]
    found = judged.agg(
        F.sum("loss"),
        *[F.sum(F.col("slope") * term) for term in terms],
        *[F.sum(F.col("bend") * terms[i] * terms[j]) for i, j in upper],
    ).first()
    gradient = np.array(found[1 : 1 + len(terms)])
    hessian = np.zeros((len(terms), len(terms)))
    for (i, j), value in zip(upper, found[1 + len(terms) :], strict=True):
        hessian[i, j] = hessian[j, i] = value
    return found[0], gradient, hessian


def _point(rows: DataFrame, names: list[str], at: np.ndarray, ridge: np.ndarray) -> _Point:
    loss, gradient, hessian = _sums(rows, names, at)
    return _Point(at, loss + (ridge * at * at).sum() / 2, gradient + ridge * at, hessian + np.diag(ridge))


def fit_logistic(
    rows: DataFrame, inputs: dict[str, Column], label: Column, weight: Column, penalty: float = 1.0
) -> Fit:
    """Minimises penalty / 2 * |weights|**2 + the summed weighted log loss; the intercept is not penalised.

    `label` is boolean and has both values.  `rows` are read once per step: pass a stored table.
    """
    names = [f"x{i}" for i in range(len(inputs))]
    data = rows.select(
        *[value.cast("double").alias(name) for name, value in zip(names, inputs.values(), strict=True)],
        label.cast("double").alias("y"),
        weight.cast("double").alias("w"),
    )
    ridge = np.array([penalty] * len(names) + [0.0])
    here = _point(data, names, np.zeros(len(ridge)), ridge)
    passes = 1
    while passes < MAX_PASSES:
        step = np.linalg.solve(here.hessian, here.gradient)
        if here.gradient @ step <= TOLERANCE * here.loss:
            return _fit(here.at - step, passes)
        share = 1.0
        while passes < MAX_PASSES:
            there = _point(data, names, here.at - share * step, ridge)
            passes += 1
            # Sums of many rows are only that exact: what is lost in them does not count as a rise.
            if there.loss <= here.loss + 1e-12 * abs(here.loss):
                break
            share /= 2
            if share < LEAST_SHARE:
                return _fit(here.at, passes)
        here = there
    raise ArithmeticError(f"no minimum after {passes} passes over the rows")


def _fit(at: np.ndarray, passes: int) -> Fit:
    return Fit([float(x) for x in at[:-1]], float(at[-1]), passes)
