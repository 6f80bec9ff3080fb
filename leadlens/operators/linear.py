"""Linear models solved on the moment matrix.

One scan gives the centred sums of products of all columns
(``functions/moments.py``); least squares, ridge and lasso are then solved on
that matrix, whose size is the square of the number of columns named, so the
rows are read once whatever the number of iterations.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.moments import merged_moments


def centred_products(df: DataFrame, cols: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, means, centred sums of products) over the rows without a NULL or
    NaN in ``cols``."""
    whole = [~F.isnan(F.coalesce(F.col(c).cast("double"), F.lit(float("nan")))) for c in cols]
    for keep in whole:
        df = df.where(keep)
    means, products, n = np.zeros(len(cols)), np.zeros((len(cols), len(cols))), 0
    for r in merged_moments(df, cols).collect():      # a row per pair of columns
        products[r.i, r.j], means[r.i], n = r.cij, r.mean_i, r.n
    return n, means, products


def lasso_on_products(xx: np.ndarray, xy: np.ndarray, alpha: float, tol: float = 1e-12, max_iter: int = 100_000) -> np.ndarray:
    """Coordinate descent for b'xx b / 2 - xy b + alpha |b|_1."""
    b = np.zeros(len(xy))
    for _ in range(max_iter):
        most = 0.0
        for j in range(len(b)):
            if xx[j, j] <= 0:
                continue
            pull = xy[j] - xx[j] @ b + xx[j, j] * b[j]
            to = np.sign(pull) * max(abs(pull) - alpha, 0.0) / xx[j, j]
            most = max(most, abs(to - b[j]) * np.sqrt(xx[j, j]))
            b[j] = to
        if most <= tol * max(1.0, np.abs(xy).max(initial=0.0)):
            break
    return b


def fit_on_moments(df: DataFrame, cols: list[str], target: str, ridge: float = 0.0, lasso: float = 0.0) -> DataFrame:
    """(feature, coefficient), the intercept included, to 6 digits.

    Minimises |y - Xb|^2 + ridge |b|^2, or |y - Xb|^2 / 2n + lasso |b|_1 if
    ``lasso`` is given; the intercept is not penalised.  A constant column has
    coefficient 0.  Without complete rows all coefficients are NULL."""
    if ridge and lasso:
        raise ValueError("give ridge or lasso, not both")
    n, means, products = centred_products(df, [*cols, target])
    xx, xy = products[:-1, :-1], products[:-1, -1]
    if not n:
        b = [None] * (len(cols) + 1)
    else:
        b = lasso_on_products(xx / n, xy / n, lasso) if lasso else np.linalg.lstsq(
            xx + ridge * np.eye(len(cols)), xy, rcond=None)[0]
        b = [float(x) for x in (*b, means[-1] - means[:-1] @ b)]
    out = df.sparkSession.createDataFrame(list(zip([*cols, "intercept"], b, strict=True)), "feature string, coefficient double")
    return out.select("feature", F.round("coefficient", 6).alias("coefficient"))
