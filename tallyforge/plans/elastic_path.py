"""Whole grids of linear regressions with elastic nets, from one scan.

The moments of features and label, kept apart by fold, say all that least squares needs to know:
the training moments of a fold are the sum of the others, and the errors on the fold itself
follow from its own. The fits are coordinate descent on the matrix of correlations, along the
penalties from the largest down, each begun where the last one ended.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..operators.moments import Moments, moments


def _fit(found: Moments, reg: float, elastic: float, start: np.ndarray, tolerance: float, rounds: int) -> np.ndarray:
    """Coefficients in units of deviations (population), as Spark's solver for few features has
    them: features and label are standardised and the penalty is measured by the label."""
    n = found.n[0, 0]
    mean = np.diag(found.s) / n
    cov = found.p / n - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(cov), 0.0))
    live = spread > 1e-12 * np.sqrt(np.diag(found.p) / n)
    scale = np.where(live, spread, 1.0)
    corr = cov / np.outer(scale, scale)
    width = len(corr) - 1
    if not live[width]:
        return np.zeros(width)
    gram, pull = corr[:width, :width], corr[:width, width]
    sharp, soft = elastic * reg / scale[width], (1 - elastic) * reg / scale[width]
    if not sharp:
        some = np.flatnonzero(live[:width])
        out = np.zeros(width)
        out[some] = np.linalg.lstsq(gram[np.ix_(some, some)] + soft * np.eye(len(some)), pull[some], rcond=None)[0]
        return out
    beta = np.where(live[:width], start, 0.0)
    for _ in range(rounds):
        moved = 0.0
        for j in np.flatnonzero(live[:width]):
            rest = pull[j] - gram[j] @ beta + beta[j]
            new = np.sign(rest) * max(abs(rest) - sharp, 0.0) / (1.0 + soft)
            moved, beta[j] = max(moved, abs(new - beta[j])), new
        if moved < tolerance:
            break
    return beta


def _line(found: Moments, beta: np.ndarray) -> tuple[np.ndarray, float]:
    """Coefficients and intercept in the columns' own units."""
    n, width = found.n[0, 0], len(beta)
    mean = np.diag(found.s) / n
    spread = np.sqrt(np.maximum(np.diag(found.p) / n - mean**2, 0.0))
    own = np.divide(beta * spread[width], spread[:width], out=np.zeros(width), where=(spread[:width] > 0) & (beta != 0))
    return own, float(mean[width] + found.shift[width] - own @ (mean[:width] + found.shift[:width]))


def _errors(found: Moments, own: np.ndarray, intercept: float) -> tuple[float, float]:
    """Root mean square error and r2 on the rows behind some moments."""
    n, width = found.n[0, 0], len(own)
    weight = np.append(-own, 1.0)
    offset = found.shift @ weight - intercept  # the error is offset plus the weighted shifted values
    mean = np.diag(found.s) / n
    square = weight @ (found.p / n) @ weight + 2 * offset * (mean @ weight) + offset**2
    spread = found.p[width, width] / n - mean[width] ** 2
    return float(np.sqrt(max(square, 0.0))), float(1 - square / spread) if spread > 0 else float("nan")


def elastic_grid(
    df: DataFrame, label: str, numeric: Sequence[str], reg: Sequence[float] = (0.01, 0.1, 0.5), elastic: Sequence[float] = (0.0, 0.5, 1.0),
    fold: str | None = None, tolerance: float = 1e-12, rounds: int = 100_000,
) -> DataFrame:
    """(fold, reg_param, elastic_net_param, intercept, coefficients, rmse, r2): one row per point
    of the grid, or with ``fold`` (a column of a few integers) per point and fold, fitted on the
    rows of the other folds; the errors are those on the fold itself (without folds, on all rows).

    Same objective as :func:`tallyforge.plans.regression.linreg_grid`. Rows with a null or NaN
    among the label and the features, or a null fold, take no part; a column that is constant
    gets 0. A fold without other rows is left out. One scan serves all; the driver holds a
    matrix of features by features per fold.
    """
    schema = "fold bigint, reg_param double, elastic_net_param double, intercept double, coefficients array<double>, rmse double, r2 double"
    found = moments(df.where(F.col(fold).isNotNull()) if fold else df, [*numeric, label], fold, whole_rows=True)
    found = {g: m for g, m in found.items() if m.n[0, 0] > 0}
    rows = []
    for own in sorted(found, key=repr):
        others = [m for g, m in found.items() if g != own] if fold else [found[own]]
        if not others:
            continue
        train = others[0]
        for more in others[1:]:
            train = train + more
        centred = train.moved(train.shift + np.diag(train.s) / np.diag(train.n))
        for e in elastic:
            beta = np.zeros(len(numeric))
            for r in sorted(reg, reverse=True):
                beta = _fit(centred, r, e, beta, tolerance, rounds)
                line, intercept = _line(centred, beta)
                rows.append((own, float(r), float(e), intercept, [float(x) for x in line], *_errors(found[own].moved(centred.shift), line, intercept)))
    return df.sparkSession.createDataFrame(rows, schema)


def best_point(grid: DataFrame) -> DataFrame:
    """(reg_param, elastic_net_param, rmse): the point with the smallest mean error over the
    folds, equal ones by the larger penalty."""
    mean = grid.groupBy("reg_param", "elastic_net_param").agg(F.avg("rmse").alias("rmse"))
    return mean.orderBy("rmse", F.desc("reg_param"), F.desc("elastic_net_param")).limit(1)
