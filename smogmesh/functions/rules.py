"""Ordered rule tables turned into ``CASE WHEN`` chains (first match wins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from smogmesh.schema import (
    CONTEXT,
    CONTEXT_LABELS,
    CRITICAL,
    FIXED_LABELS,
    SERVICE_LABELS,
    SERVICE_STOPPED,
    ContextLimits,
    CriticalLimits,
)

Rule = tuple[str, Column]


def first_match(rules: Sequence[Rule], default: str | None = None) -> Column:
    """``when(r1, l1).when(r2, l2)...otherwise(default)``; a null test falls through."""
    if not rules:
        return F.lit(default)
    label, cond = rules[0]
    chain = F.when(cond, label)
    for label, cond in rules[1:]:
        chain = chain.when(cond, label)
    return chain.otherwise(default) if default is not None else chain


def any_rule(rules: Sequence[Rule]) -> Column:
    """True when at least one rule holds (null-safe: null counts as false)."""
    out = None
    for _, cond in rules:
        c = F.coalesce(cond, F.lit(False))
        out = c if out is None else out | c
    return out


def critical_rules(limits: CriticalLimits = CRITICAL) -> list[Rule]:
    """Fixed-limit rules, in the order they are checked."""
    pm25, pm10, no2, o3, co2, temp = FIXED_LABELS
    t = F.col("temperature")
    return [
        (pm25, F.col("pm25") > limits.pm25),
        (pm10, F.col("pm10") > limits.pm10),
        (no2, F.col("no2") > limits.no2),
        (o3, F.col("o3") > limits.o3),
        (co2, F.col("co2") > limits.co2),
        (temp, (t < limits.temp_min) | (t > limits.temp_max)),
    ]


def rush_hour(hour: Column, limits: ContextLimits = CONTEXT) -> Column:
    out = None
    for lo, hi in limits.rush:
        c = hour.between(lo, hi)
        out = c if out is None else out | c
    return out


def context_rules(limits: ContextLimits = CONTEXT) -> list[Rule]:
    """Contextual rules: silent sensor in rush hour, high reading at night, extreme temperature."""
    zero_peak, night_high, temp = CONTEXT_LABELS
    hour, pm25, t = F.col("hour"), F.col("pm25"), F.col("temperature")
    return [
        (zero_peak, rush_hour(hour, limits) & (pm25 == 0)),
        (night_high, hour.between(*limits.night) & (pm25 > limits.night_pm25)),
        (temp, (t < limits.temp_min) | (t > limits.temp_max)),
    ]


def service_period(hour: Column | str = "hour") -> Column:
    """Transport service period of an hour: rush, stopped (1 <= h < 5) or normal."""
    h = F.col(hour) if isinstance(hour, str) else hour
    rush, stopped, normal = SERVICE_LABELS
    lo, hi = SERVICE_STOPPED
    return (
        F.when(rush_hour(h), rush)
        .when((h >= lo) & (h < hi), stopped)
        .when(h.isNotNull(), normal)
    )
