"""Pollution indices as Column expressions (JVM-side, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from smogmesh.schema import (
    DANGER_ABOVE,
    INDEX_WEIGHTS,
    RAISED_ABOVE,
    SEVERITY_LABELS,
    SIMPLE_WEIGHTS,
    WHO_LIMITS,
    Limits,
    Weights,
)

_POLLUTANTS = ("pm25", "pm10", "co2", "no2", "o3")


def who_index(
    *,
    limits: Limits = WHO_LIMITS,
    weights: Weights = INDEX_WEIGHTS,
    nulls: str = "null",
    prefix: str = "",
) -> Column:
    """Weighted sum of the five pollutants, each divided by its WHO limit.

    ``nulls="null"``: a missing pollutant makes the index null (column form,
    skipped by ``avg`` but counted by ``count(*)``).
    ``nulls="zero"``: a missing pollutant counts as 0 (row form of the
    station ranking).
    """
    if nulls not in ("null", "zero"):
        raise ValueError("nulls must be 'null' or 'zero'")
    total = None
    for name in _POLLUTANTS:
        c = F.col(prefix + name)
        if nulls == "zero":
            c = F.coalesce(c, F.lit(0))
        term = (c / F.lit(getattr(limits, name))) * F.lit(getattr(weights, name))
        total = term if total is None else total + term
    return total / F.lit(weights.divisor)


def weighted_index(weights: tuple[tuple[str, float], ...] = SIMPLE_WEIGHTS) -> Column:
    """Simple weighted index ``pm25*0.5 + pm10*0.3 + co2*0.2``."""
    total = None
    for name, w in weights:
        term = F.col(name) * F.lit(w)
        total = term if total is None else total + term
    return total


def severity(index: Column, *, unknown_label: str | None = None) -> Column:
    """Severity band of an index: > 1 danger, > 0.5 raised, else normal.

    A null index is normal by default (a missing sensor hides an alert); pass
    ``unknown_label`` to give it its own label instead.
    """
    danger, raised, normal = SEVERITY_LABELS
    chain = F.when(index > F.lit(DANGER_ABOVE), danger).when(index > F.lit(RAISED_ABOVE), raised)
    if unknown_label is not None:
        chain = chain.when(index.isNull(), unknown_label)
    return chain.otherwise(normal)
