"""Linear regression from sufficient statistics: one pass over the rows, everything else on small matrices.

Sums of products per fold are all that least squares, ridge and elastic net need. A fold's training sums
are the total less the fold's own, so folds x grid models cost one aggregation instead of one pass each.
What reaches the driver is one matrix per fold, whose size depends on the number of features only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

#: More features than this make the matrix too large for one aggregation.
MOST_FEATURES = 200
TOLERANCE = 1e-12
SWEEPS = 100_000


def centres(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Means of the columns, to take off before products are added: sums of products of numbers far from
    zero lose their digits."""
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).first()
    return {c: float(means[c] or 0.0) for c in columns}


def fold_moments(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    fold: str | None = None,
    *,
    shift: Mapping[str, float] | None = None,
) -> DataFrame:
    """One row per fold and pair of columns: `fold`, `i`, `j` (i <= j), `value`, the sum of products.

    Column 0 is the constant 1, columns 1 to k are the features and the last one is the target. `shift`
    is taken off each column first. Rows with a NULL in any of the columns are left out. Every task adds
    up its own rows; one row per fold is shuffled.
    """
    if len(features) > MOST_FEATURES:
        raise ValueError(f"more than {MOST_FEATURES} features: use a solver that makes several passes")
    names = [*features, target]
    shift = shift or {}
    values = [F.lit(1.0), *[F.col(c).cast("double") - F.lit(float(shift.get(c, 0.0))) for c in names]]
    key = F.lit(0) if fold is None else F.col(fold)
    rows = df.dropna(subset=names).select(key.alias("fold"), *[v.alias(f"v{i}") for i, v in enumerate(values)])
    pairs = list(combinations_with_replacement(range(len(values)), 2))
    sums = rows.groupBy("fold").agg(*[F.sum(F.col(f"v{i}") * F.col(f"v{j}")).alias(f"s{n}") for n, (i, j) in enumerate(pairs)])
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"s{n}").alias("value")) for n, (i, j) in enumerate(pairs)])
    return sums.select("fold", F.explode(cells).alias("cell")).select("fold", "cell.*")


@dataclass(frozen=True)
class Moments:
    """Sums of products of (1, features, target), all less their shifts."""

    features: tuple[str, ...]
    shift: np.ndarray
    total: np.ndarray
    folds: dict

    @property
    def size(self) -> int:
        return len(self.features)


def collect_moments(
    df: DataFrame, features: Sequence[str], target: str, fold: str | None = None
) -> Moments:
    """The matrices of all folds on the driver: (k + 2)^2 / 2 numbers per fold, however many rows."""
    shift = centres(df, [*features, target])
    size = len(features) + 2
    folds: dict = {}
    for row in fold_moments(df, features, target, fold, shift=shift).collect():
        matrix = folds.setdefault(row["fold"], np.zeros((size, size)))
        matrix[row["i"], row["j"]] = matrix[row["j"], row["i"]] = row["value"]
    total = sum(folds.values(), np.zeros((size, size)))
    return Moments(tuple(features), np.array([shift[c] for c in [*features, target]]), total, folds)


@dataclass(frozen=True)
class LinearModel:
    """`intercept` + sum of `coefficients` times features."""

    features: tuple[str, ...]
    intercept: float
    coefficients: np.ndarray

    def prediction(self):
        """The prediction as a column expression; no Python runs on rows."""
        value = F.lit(float(self.intercept))
        for name, c in zip(self.features, self.coefficients):
            value = value + F.lit(float(c)) * F.col(name)
        return value


def _standardised(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Correlations among features and with the target, standard deviations (population) and means."""
    n = matrix[0, 0]
    mean = matrix[0, 1:] / n
    cov = matrix[1:, 1:] / n - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(cov), 0.0))
    # A constant column keeps a spread of 0 and gets the coefficient 0.
    safe = np.where(spread > 1e-12 * np.maximum(1.0, np.abs(mean)), spread, np.inf)
    scaled = cov / np.outer(safe, safe)
    return scaled[:-1, :-1], scaled[:-1, -1], np.where(np.isinf(safe), 0.0, spread), mean


def solve_ridge(gram: np.ndarray, right: np.ndarray, l2: float) -> np.ndarray:
    """Closed form; the least-norm solution where the matrix is singular."""
    return np.linalg.lstsq(gram + l2 * np.eye(len(gram)), right, rcond=None)[0]


def solve_elastic_net(gram: np.ndarray, right: np.ndarray, l1: float, l2: float) -> np.ndarray:
    """Cyclic coordinate descent on the matrix until no coefficient moves by more than `TOLERANCE`."""
    beta = np.zeros(len(gram))
    slope = right.copy()  # right - gram @ beta
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(len(beta)):
            own = gram[j, j]
            if own + l2 <= 0:
                continue
            free = slope[j] + own * beta[j]
            new = np.sign(free) * max(abs(free) - l1, 0.0) / (own + l2)
            if (step := new - beta[j]) != 0.0:
                slope -= gram[:, j] * step
                beta[j] = new
                moved = max(moved, abs(step))
        if moved <= TOLERANCE:
            break
    return beta


def fit(moments: Moments, reg: float = 0.0, mix: float = 0.0, matrix: np.ndarray | None = None) -> LinearModel:
    """The model that minimises half the mean squared error plus `reg` times the penalty, on standardised
    columns: (1 - mix) / 2 of the squares and `mix` of the absolute values of the coefficients. These are
    the parameters `regParam` and `elasticNetParam` of Spark's `LinearRegression`."""
    matrix = moments.total if matrix is None else matrix
    if matrix[0, 0] == 0:
        raise ValueError("no rows without NULL to fit a model to")
    gram, right, spread, mean = _standardised(matrix)
    if spread[-1] == 0:
        beta = np.zeros(moments.size)
    else:
        penalty = reg / spread[-1]
        l1, l2 = mix * penalty, (1.0 - mix) * penalty
        beta = solve_ridge(gram, right, l2) if l1 == 0 else solve_elastic_net(gram, right, l1, l2)
    scale = np.divide(spread[-1], spread[:-1], out=np.zeros(moments.size), where=spread[:-1] > 0)
    coefficients = beta * scale
    centre = mean + moments.shift
    return LinearModel(moments.features, float(centre[-1] - coefficients @ centre[:-1]), coefficients)


def squared_error(moments: Moments, model: LinearModel, matrix: np.ndarray) -> float:
    """Sum of squared errors over the rows of a matrix, without the rows."""
    inner = model.intercept + model.coefficients @ moments.shift[:-1] - moments.shift[-1]
    weights = np.array([inner, *model.coefficients, -1.0])
    return float(max(weights @ matrix @ weights, 0.0))


def grid_errors(moments: Moments, grid: Sequence[tuple[float, float]]) -> list[tuple]:
    """(fold, reg, mix, rows, rmse) of every held-out fold and parameter pair; training sums are all
    other folds' together."""
    rows = []
    for fold, own in sorted(moments.folds.items()):
        for reg, mix in grid:
            model = fit(moments, reg, mix, moments.total - own)
            rows.append((int(fold), float(reg), float(mix), int(round(own[0, 0])), float((squared_error(moments, model, own) / own[0, 0]) ** 0.5)))
    return rows


def grid_table(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "fold int, reg double, mix double, n long, rmse double")


def best_of(rows: Sequence[tuple]) -> tuple[float, float]:
    """(reg, mix) with the smallest mean error over the folds; ties go to the smaller parameters."""
    errors: dict[tuple[float, float], list[float]] = {}
    for _, reg, mix, _, rmse in rows:
        errors.setdefault((reg, mix), []).append(rmse)
    return min(errors, key=lambda pair: (sum(errors[pair]) / len(errors[pair]), pair))


def cross_validate(
    df: DataFrame, features: Sequence[str], target: str, fold: str, grid: Sequence[tuple[float, float]]
) -> LinearModel:
    """The model of the best parameters, fitted to all rows. One pass over the rows (and one for means)."""
    moments = collect_moments(df, features, target, fold)
    return fit(moments, *best_of(grid_errors(moments, grid)))
