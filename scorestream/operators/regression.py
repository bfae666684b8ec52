"""Linear regression by normal equations: one combined aggregate, no row leaves the executors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

#: The covariance table goes to the driver; its size is the square of the columns.
MOST_COLUMNS = 200


@dataclass(frozen=True)
class LinearModel:
    columns: tuple[str, ...]
    slopes: tuple[float, ...]
    intercept: float

    def prediction(self) -> Column:
        terms = [F.col(c).cast("double") * s for c, s in zip(self.columns, self.slopes)]
        return sum(terms, F.lit(self.intercept))

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return df.withColumn(output, self.prediction())


def fit_linear(df: DataFrame, columns: Sequence[str], target: str, ridge: float = 0.0) -> LinearModel:
    """Least squares of ``target`` on ``columns`` with an intercept.

    Means and covariances come from one pass of mergeable aggregates, so sums of
    squares of large values do not cancel.  Rows with a null or NaN in any of the
    columns take no part.  A column that does not vary, or follows from others, has
    the least-norm slope.  ``ridge`` is added to every variance.
    """
    if len(columns) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} columns")
    names = [*columns, target]
    rows = df.select(*(F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names))).dropna()
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    found = rows.agg(
        F.count("*").alias("n"),
        *(F.avg(f"c{i}").alias(f"m{i}") for i in range(len(names))),
        *(F.covar_pop(f"c{i}", f"c{j}").alias(f"v{i}_{j}") for i, j in pairs),
    ).first()
    if not found["n"]:
        raise ValueError("no rows without nulls")
    spread = np.zeros((len(names), len(names)))
    for i, j in pairs:
        spread[i, j] = spread[j, i] = found[f"v{i}_{j}"]
    d = len(columns)
    slopes = np.linalg.pinv(spread[:d, :d] + ridge * np.eye(d), hermitian=True) @ spread[:d, d]
    means = np.array([found[f"m{i}"] for i in range(d + 1)])
    return LinearModel(tuple(columns), tuple(map(float, slopes)), float(means[d] - slopes @ means[:d]))
