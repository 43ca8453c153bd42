"""Time columns: epoch milliseconds to date parts, weekday names, period labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from smogmesh.schema import WEEKDAY_UNKNOWN, WEEKDAYS

_EPOCH = "1970-01-01 00:00:00"


def epoch_ms_to_datetime(ms: Column | str = "timestamp") -> Column:
    """Epoch milliseconds → UTC wall-clock ``timestamp_ntz`` truncated to the second.

    Independent of the session time zone, unlike ``from_unixtime``.
    """
    c = F.col(ms) if isinstance(ms, str) else ms
    seconds = F.floor(c / 1000)
    return F.timestamp_add("SECOND", seconds, F.lit(_EPOCH).cast("timestamp_ntz"))


def time_parts(df, ms: str = "timestamp"):
    """Add ``datetime`` (text, yyyy-MM-dd HH:mm:ss) and year / month / day / hour parts."""
    dt = epoch_ms_to_datetime(ms)
    return (
        df.withColumn("_dt", dt)
        .withColumn("datetime", F.date_format("_dt", "yyyy-MM-dd HH:mm:ss"))
        .withColumn("year", F.year("_dt"))
        .withColumn("month_extracted", F.month("_dt"))
        .withColumn("day_extracted", F.dayofmonth("_dt"))
        .withColumn("hour_extracted", F.hour("_dt"))
        .drop("_dt")
    )


def weekday_name(day: Column | str = "day_of_week", *, fallback: str | None = WEEKDAY_UNKNOWN) -> Column:
    """1..7 → Lundi..Dimanche; other values give ``fallback`` (None → null)."""
    d = F.col(day) if isinstance(day, str) else day
    chain = None
    for i, name in enumerate(WEEKDAYS, start=1):
        chain = F.when(d == i, name) if chain is None else chain.when(d == i, name)
    return chain.otherwise(fallback) if fallback is not None else chain


def period_label(day: Column | str = "day_of_week", hour: Column | str = "hour") -> Column:
    """``"<weekday> - <hour>h"``; null when the weekday is unknown."""
    h = F.col(hour) if isinstance(hour, str) else hour
    return F.concat(weekday_name(day, fallback=None), F.lit(" - "), h.cast("string"), F.lit("h"))
