"""Time profiles and per-station / per-line statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogmesh.functions.calendar import period_label, weekday_name
from smogmesh.functions.indices import weighted_index, who_index

INDEX = "pollution_index"


def with_who_index(df: DataFrame, *, nulls: str = "null", name: str = INDEX) -> DataFrame:
    return df.withColumn(name, who_index(nulls=nulls))


def _mean(c: str, digits: int | None) -> Column:
    m = F.avg(c)
    return F.round(m, digits) if digits is not None else m


def _profile_aggs(digits: int | None) -> list[Column]:
    return [
        _mean(INDEX, digits).alias("pollution_moyenne"),
        _mean("pm25", digits).alias("pm25_moyen"),
        _mean("pm10", digits).alias("pm10_moyen"),
        _mean("co2", digits).alias("co2_moyen"),
        _mean("no2", digits).alias("no2_moyen"),
        _mean("noise", digits).alias("bruit_moyen"),
        F.count(F.lit(1)).alias("nb_mesures"),
    ]


def _indexed(df: DataFrame) -> DataFrame:
    return df if INDEX in df.columns else with_who_index(df)


def hourly_profile(df: DataFrame, *, digits: int | None = 2) -> DataFrame:
    """Per hour: mean index and pollutants (rounded), and the number of readings."""
    return _indexed(df).groupBy("hour").agg(*_profile_aggs(digits)).orderBy("hour")


def peak_hours(df: DataFrame, *, k: int = 5, calm: bool = False, digits: int | None = 2) -> DataFrame:
    """The k most (or, with ``calm``, least) polluted hours, by the rounded mean index.

    Ties are broken by hour.  Nulls sort last for the most polluted and first
    for the calmest, as a plain descending / ascending sort does.
    """
    prof = hourly_profile(df, digits=digits)
    key = F.col("pollution_moyenne").asc_nulls_first() if calm else F.col("pollution_moyenne").desc_nulls_last()
    return prof.orderBy(key, F.col("hour").asc()).limit(k)


def weekday_profile(df: DataFrame, *, digits: int | None = 2) -> DataFrame:
    """Per weekday: same figures as the hourly profile, without no2, by mean index desc."""
    return (
        _indexed(df)
        .groupBy("day_of_week")
        .agg(*_profile_aggs(digits))
        .withColumn("jour", weekday_name("day_of_week"))
        .orderBy(F.col("pollution_moyenne").desc_nulls_last(), F.col("day_of_week"))
        .select("jour", "pollution_moyenne", "pm25_moyen", "pm10_moyen", "co2_moyen", "bruit_moyen", "nb_mesures")
    )


def weekday_hour_profile(df: DataFrame, *, digits: int | None = 2) -> DataFrame:
    """Per (weekday, hour): mean index and number of readings, with the period label."""
    return (
        _indexed(df)
        .groupBy("day_of_week", "hour")
        .agg(_mean(INDEX, digits).alias("pollution_moyenne"), F.count(F.lit(1)).alias("nb_mesures"))
        .withColumn("jour", weekday_name("day_of_week", fallback=None))
        .withColumn("periode", period_label("day_of_week", "hour"))
    )


def critical_periods(df: DataFrame, *, k: int = 20, digits: int | None = 2) -> DataFrame:
    """The k (weekday, hour) periods with the highest mean index; ties by weekday, hour."""
    return (
        weekday_hour_profile(df, digits=digits)
        .orderBy(F.col("pollution_moyenne").desc_nulls_last(), "day_of_week", "hour")
        .limit(k)
        .select("periode", "pollution_moyenne", "nb_mesures")
    )


def station_pm25(df: DataFrame) -> DataFrame:
    """Per station: mean, max and min pm25."""
    return df.groupBy("station_id", "station_name").agg(
        F.avg("pm25").alias("pm25_avg"), F.max("pm25").alias("pm25_max"), F.min("pm25").alias("pm25_min")
    )


def line_co2(df: DataFrame, *, by: tuple[str, ...] = ("line",)) -> DataFrame:
    """Per line: mean, max and min co2.

    By default lines are keyed by name only, so equally named lines of two
    cities are merged; pass ``by=("city", "line")`` to keep them apart.
    """
    return df.groupBy(*by).agg(
        F.avg("co2").alias("co2_avg"), F.max("co2").alias("co2_max"), F.min("co2").alias("co2_min")
    )


def weighted_readings(df: DataFrame) -> DataFrame:
    """Station name and the simple weighted index of every reading."""
    return df.select("station_name", weighted_index().alias("pollution_index"))


def high_readings(df: DataFrame, *, above: int = 70) -> DataFrame:
    """Readings with pm25 above a limit."""
    return df.filter(F.col("pm25") > above)


def service_periods(df: DataFrame) -> DataFrame:
    """Number of readings per transport service period (rush / stopped / normal)."""
    from smogmesh.functions.rules import service_period

    return df.groupBy(service_period("hour").alias("period")).agg(F.count(F.lit(1)).alias("count"))


def name_tokens(df: DataFrame, *, sep: str = "-") -> DataFrame:
    """One row per part of each station name (trailing empty parts dropped)."""
    from smogmesh.functions.text import split_keep_leading

    return df.select(F.explode(split_keep_leading("station_name", sep)).alias("token"))


def with_time_parts(df: DataFrame) -> DataFrame:
    """Timestamp with its datetime text and year, month, day, hour parts (UTC)."""
    from smogmesh.functions.calendar import time_parts

    return time_parts(df.select("timestamp")).select(
        "timestamp", "datetime", "year", "month_extracted", "day_extracted", "hour_extracted"
    )
