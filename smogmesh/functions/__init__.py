"""Column builders (no UDFs)."""

from smogmesh.functions.calendar import epoch_ms_to_datetime, period_label, time_parts, weekday_name
from smogmesh.functions.indices import severity, weighted_index, who_index
from smogmesh.functions.rules import (
    any_rule,
    context_rules,
    critical_rules,
    first_match,
    rush_hour,
    service_period,
)
from smogmesh.functions.text import lines_text, split_keep_leading

__all__ = [
    "any_rule",
    "context_rules",
    "critical_rules",
    "epoch_ms_to_datetime",
    "first_match",
    "lines_text",
    "period_label",
    "rush_hour",
    "service_period",
    "severity",
    "split_keep_leading",
    "time_parts",
    "weekday_name",
    "weighted_index",
    "who_index",
]
