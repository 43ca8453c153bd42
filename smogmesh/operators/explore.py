"""Exploratory statistics: correlations, distribution summary, frequent values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CORRELATED = ("pm10", "co2", "no2", "o3", "temperature", "humidity", "wind_speed", "noise")


def correlations(df: DataFrame, *, target: str = "pm25", others: Sequence[str] = CORRELATED) -> DataFrame:
    """One row: Pearson correlation of ``target`` with each other column.

    Computed over the rows where both values are present; a constant column
    gives null instead of a division error.
    """
    t = F.col(target)
    out = []
    for o in others:
        x = F.col(o)
        both = t.isNotNull() & x.isNotNull()
        tt, xx = F.when(both, t), F.when(both, x)
        denom = F.stddev_pop(tt) * F.stddev_pop(xx)
        out.append(F.try_divide(F.covar_pop(tt, xx), denom).alias(o))
    return df.agg(*out)


def describe_column(df: DataFrame, col: str = "pm25") -> DataFrame:
    """One row: count, mean, sample stddev, min, max (typed, unlike ``describe``)."""
    c = F.col(col)
    return df.agg(
        F.count(c).alias("count"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("stddev"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
    )


def top_values(df: DataFrame, col: str = "pm25", *, k: int = 10) -> DataFrame:
    """The k most frequent values of a column (ties by value)."""
    return (
        df.groupBy(col)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), F.col(col).asc_nulls_first())
        .limit(k)
    )
