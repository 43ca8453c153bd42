"""Ridge regression by normal equations: one distributed aggregate of moments, one small system.

The table is read once: means and all pairwise covariances of features and label
come from a single aggregate with partial results in the tasks.  The system that is
left has as many rows as there are features and is solved on the driver.

The objective is that of a standardised ridge: with ``z`` the features over their
population deviations, and the label over its own,
``1/2n * sum((y - z w - b)**2) + reg / (2 sd(y)) * sum(w**2)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def moments(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """One row: ``n``, the means ``m<i>`` and population covariances ``c<i>_<j>`` (i <= j).

    Numbers follow ``features``; the label is the last.  Rows with a null in any
    of the columns do not count.
    """
    cols = [*features, label]
    complete = None
    for c in cols:
        t = F.col(c).isNotNull()
        complete = t if complete is None else complete & t
    rows = df.filter(complete).select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    k = len(cols)
    aggs = [F.count(F.lit(1)).alias("n"), *[F.avg(f"x{i}").alias(f"m{i}") for i in range(k)]]
    aggs += [F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i in range(k) for j in range(i, k)]
    return rows.agg(*aggs)


@dataclass
class Ridge:
    """A solved ridge regression; ``gradient`` is the norm of the objective's gradient at the solution."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    n: int
    gradient: float

    def table(self, spark: SparkSession) -> DataFrame:
        """``position, term, coefficient``: the intercept (position 0), then the features in order."""
        rows = [(0, "intercept", float(self.intercept))]
        rows += [(i + 1, f, float(c)) for i, (f, c) in enumerate(zip(self.features, self.coefficients))]
        return spark.createDataFrame(rows, "position int, term string, coefficient double")

    def predict(self, df: DataFrame, *, output: str = "prediction") -> DataFrame:
        """``df`` with the estimate; null where a feature is null."""
        estimate = F.lit(float(self.intercept))
        for f, c in zip(self.features, self.coefficients):
            estimate = estimate + F.col(f).cast("double") * F.lit(float(c))
        return df.withColumn(output, estimate)


def fit_ridge(df: DataFrame, features: Sequence[str], label: str = "label", *, reg: float = 0.01) -> Ridge | None:
    """Fit on the rows that have all features and the label; None without such rows.

    A constant feature gets coefficient 0; with a constant label all coefficients are 0.
    """
    row = moments(df, features, label).first()
    n, k = row["n"], len(features)
    if not n:
        return None
    mean = np.array([row[f"m{i}"] for i in range(k + 1)])
    cov = np.array([[row[f"c{min(i, j)}_{max(i, j)}"] for j in range(k + 1)] for i in range(k + 1)])
    # A spread below rounding noise counts as none.
    noise = (1e-9 * (np.abs(mean) + 1e-300)) ** 2
    dev = np.sqrt(np.where(np.diag(cov) > noise, np.diag(cov), 0.0))
    live = np.flatnonzero(dev[:k] > 0)
    w = np.zeros(k)
    gradient = 0.0
    if dev[k] > 0 and len(live):
        scale = np.outer(dev[live], dev[live])
        system = cov[np.ix_(live, live)] / scale + reg / dev[k] * np.eye(len(live))
        right = cov[live, k] / (dev[live] * dev[k])
        solved = np.linalg.solve(system, right)
        gradient = float(np.linalg.norm(system @ solved - right))
        w[live] = solved * dev[k] / dev[live]
    return Ridge(tuple(features), tuple(w.tolist()), float(mean[k] - w @ mean[:k]), n, gradient)
