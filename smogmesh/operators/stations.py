"""Station ranking and network totals on the index with missing values read as 0."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogmesh.functions.indices import who_index
from smogmesh.schema import PEAK_INDEX

KEYS = ("station_id", "station_name", "city", "line")


def station_stats(df: DataFrame, *, nulls: str = "zero") -> DataFrame:
    """Per (station, line): mean, min, max of the index and the number of readings.

    Built-in aggregates with a map-side partial step: one shuffle, one row
    per key on the wire from each task however hot a station is.
    """
    idx = who_index(nulls=nulls)
    return df.groupBy(*KEYS).agg(
        F.avg(idx).alias("mean_index"),
        F.min(idx).alias("min_index"),
        F.max(idx).alias("max_index"),
        F.count(F.lit(1)).alias("n_readings"),
    )


def station_ranking(df: DataFrame, *, k: int = 10, nulls: str = "zero") -> DataFrame:
    """Top k stations by mean index (ties by key); planned as a top-k, not a full sort."""
    return station_stats(df, nulls=nulls).orderBy(F.col("mean_index").desc(), *KEYS).limit(k)


def station_peaks(
    df: DataFrame, *, limit: float = PEAK_INDEX, k: int = 10, order_by: str = "mean", nulls: str = "zero"
) -> DataFrame:
    """First k stations whose max index exceeds ``limit``, ordered by mean (or ``order_by="max"``)."""
    key = "max_index" if order_by == "max" else "mean_index"
    return (
        station_stats(df, nulls=nulls)
        .filter(F.col("max_index") > limit)
        .orderBy(F.col(key).desc(), *KEYS)
        .limit(k)
    )


def network_total(df: DataFrame, *, nulls: str = "zero") -> DataFrame:
    """Sum, count and mean of the index over all readings.

    ``total`` is a reduce (null on empty input); ``total_fold`` starts from 0.0.
    """
    idx = who_index(nulls=nulls)
    return df.agg(
        F.sum(idx).alias("total"),
        F.count(F.lit(1)).alias("n_readings"),
        F.avg(idx).alias("mean_index"),
        F.coalesce(F.sum(idx), F.lit(0.0)).alias("total_fold"),
    )
