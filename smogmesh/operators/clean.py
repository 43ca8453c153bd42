"""Cleaning and data-quality operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe(df: DataFrame) -> DataFrame:
    """Drop exact duplicate rows (all columns).

    Planned as a hash aggregate with a map-side partial step, so a group of
    copies holding a large share of the rows is collapsed before the shuffle.
    """
    return df.dropDuplicates()


def drop_missing(df: DataFrame) -> DataFrame:
    """Drop rows with a null in any column (same rows as ``dropna(how="any")``).

    Written as one ``IS NOT NULL`` test per column rather than ``dropna``:
    ``dropna`` becomes a single predicate over all columns, and when it is
    pushed below a projection of renamed columns the optimizer enumerates
    every renamed / original combination of its arguments (2^n constraints),
    which can stall planning for minutes.  Per-column tests grow linearly.
    """
    cond = None
    for c in df.columns:
        t = F.col(f"`{c}`").isNotNull()
        cond = t if cond is None else cond & t
    return df if cond is None else df.filter(cond)


def clean(df: DataFrame) -> DataFrame:
    """Dedupe, then drop rows with missing values."""
    return df.transform(dedupe).transform(drop_missing)


def quality_profile(df: DataFrame) -> DataFrame:
    """One-row data-quality report: rows, duplicate rows, nulls per column, rows kept.

    Single shuffle: rows are first grouped by all columns (partial aggregation
    collapses copies map-side), then one global aggregate over the groups
    gives every figure.  ``rows_kept`` equals ``clean(df).count()``.
    """
    cols = df.columns
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    n = F.col("_n")
    complete = None
    for c in cols:
        t = F.col(c).isNotNull()
        complete = t if complete is None else complete & t
    aggs = [
        F.coalesce(F.sum(n), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(n - 1), F.lit(0)).alias("duplicate_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.count(F.when(complete, 1)).alias("rows_kept"),
    ]
    aggs += [
        F.coalesce(F.sum(F.when(F.col(c).isNull(), n)), F.lit(0)).alias(f"null_{c}") for c in cols
    ]
    return groups.agg(*aggs)


def network_inventory(df: DataFrame, *, totals: bool = True) -> DataFrame:
    """Lines and stations per city; with ``totals`` one more row (``is_total``) for the whole network.

    Readings are first counted per (city, line, station); only that small
    table is rolled up.
    """
    small = df.groupBy("city", "line", "station_id").agg(F.count(F.lit(1)).alias("_n"))
    figures = (
        F.countDistinct("line").alias("n_lines"),
        F.countDistinct("station_id").alias("n_stations"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_readings"),
    )
    if not totals:
        return small.groupBy("city").agg(*figures)
    mark = (F.grouping("city") == 1).alias("is_total")
    return small.rollup("city").agg(*figures, mark)
