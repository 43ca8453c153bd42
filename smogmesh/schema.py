"""Schemas of the readings table and the sensor stream, and the fixed rule values.

Every operator in the package takes a DataFrame with (a superset of) these
columns.  The constants below are part of the semantics: results only match
the original analyses when these exact numbers are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Table schemas
# --------------------------------------------------------------------------

#: Batch readings, one row per station measurement (20 flat columns).
READINGS = T.StructType(
    [
        T.StructField("station_id", T.IntegerType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("line", T.StringType()),
        T.StructField("timestamp", T.LongType()),  # epoch milliseconds
        T.StructField("hour", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),  # 1 = Monday .. 7 = Sunday
        T.StructField("month", T.IntegerType()),
        T.StructField("pm25", T.IntegerType()),
        T.StructField("pm10", T.IntegerType()),
        T.StructField("co2", T.IntegerType()),
        T.StructField("no2", T.IntegerType()),
        T.StructField("o3", T.IntegerType()),
        T.StructField("noise", T.IntegerType()),
        T.StructField("humidity", T.IntegerType()),
        T.StructField("temperature", T.IntegerType()),
        T.StructField("wind_speed", T.DoubleType()),
        T.StructField("rain", T.IntegerType()),
    ]
)

READING_COLUMNS: tuple[str, ...] = tuple(f.name for f in READINGS.fields)

#: Stream readings: headerless CSV, one file per drop.
SENSOR = T.StructType(
    [
        T.StructField("station_id", T.IntegerType()),
        T.StructField("pm25", T.IntegerType()),
        T.StructField("pm10", T.IntegerType()),
        T.StructField("co2", T.IntegerType()),
        T.StructField("no2", T.IntegerType()),
        T.StructField("o3", T.IntegerType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

SENSOR_COLUMNS: tuple[str, ...] = tuple(f.name for f in SENSOR.fields)

#: Name of the column that receives rows the CSV parser could not read.
CORRUPT_COLUMN = "_corrupt_record"

# --------------------------------------------------------------------------
# Fixed values (must stay equal to the original analyses)
# --------------------------------------------------------------------------


@dataclass(frozen=True)
class Limits:
    """WHO reference limits used to normalise each pollutant in the index."""

    pm25: float = 25.0
    pm10: float = 50.0
    co2: float = 1000.0
    no2: float = 40.0
    o3: float = 100.0


@dataclass(frozen=True)
class Weights:
    """Index weights per pollutant and the divisor of the weighted sum."""

    pm25: float = 3.0
    pm10: float = 2.0
    co2: float = 0.5
    no2: float = 2.0
    o3: float = 1.0
    divisor: float = 8.5


@dataclass(frozen=True)
class CriticalLimits:
    """Critical limits of the fixed-limit detector, checked in this order."""

    pm25: float = 75.0
    pm10: float = 150.0
    no2: float = 100.0
    o3: float = 200.0
    co2: float = 1500.0
    temp_min: float = 0.0
    temp_max: float = 45.0


@dataclass(frozen=True)
class ContextLimits:
    """Contextual detector: rush hours, night window, plausible temperatures."""

    rush: tuple[tuple[int, int], ...] = ((7, 9), (17, 20))
    night: tuple[int, int] = (1, 5)
    night_pm25: float = 30.0
    temp_min: float = -10.0
    temp_max: float = 50.0


WHO_LIMITS = Limits()
INDEX_WEIGHTS = Weights()
CRITICAL = CriticalLimits()
CONTEXT = ContextLimits()

# Severity bands of the streaming index: > DANGER_ABOVE, > RAISED_ABOVE, else normal.
DANGER_ABOVE = 1.0
RAISED_ABOVE = 0.5

# Simple weighted index of the batch job: pm25*0.5 + pm10*0.3 + co2*0.2.
SIMPLE_WEIGHTS = (("pm25", 0.5), ("pm10", 0.3), ("co2", 0.2))

# Detector parameters.
Z_LIMIT = 3.0
IQR_FENCE = 1.5
QUANTILE_ERROR = 0.01
HIGH_PM25 = 70
PEAK_INDEX = 2.0

# Graph propagation.
PROPAGATION_ROUNDS = 5
PROPAGATION_FACTOR = 0.1

# Service periods: rush hours as above; service stopped from 1 h up to (not including) 5 h.
SERVICE_STOPPED = (1, 5)

# Labels (fixed values, in rule order).
FIXED_LABELS = (
    "PM2.5_CRITIQUE",
    "PM10_CRITIQUE",
    "NO2_CRITIQUE",
    "O3_CRITIQUE",
    "CO2_CRITIQUE",
    "TEMP_IMPOSSIBLE",
)
FIXED_NORMAL = "NORMAL"
ZSCORE_LABELS = ("PM2.5_OUTLIER", "PM10_OUTLIER", "CO2_OUTLIER", "NO2_OUTLIER")
CONTEXT_LABELS = ("POLLUTION_NULLE_POINTE", "POLLUTION_ELEVEE_NUIT", "TEMP_EXTREME")
SEVERITY_LABELS = ("DANGER", "ELEVEE", "NORMALE")
WEEKDAYS = ("Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche")
WEEKDAY_UNKNOWN = "Inconnu"
SERVICE_LABELS = ("rush", "stopped", "normal")

# ML: features in the order of the feature vector.
FEATURES = (
    "hour",
    "day_of_week",
    "month",
    "pm10",
    "co2",
    "no2",
    "o3",
    "noise",
    "humidity",
    "temperature",
    "wind_speed",
    "rain",
    "line_indexed",
    "city_indexed",
)
