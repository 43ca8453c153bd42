"""Rows and places shared by the tests (not in conftest: another folder's conftest may stand before it)."""

from smogmesh.schema import READINGS

SF_SMALL = "/root/testdata/sf0.001"

BASE = {
    "station_id": 1,
    "station_name": "Paris-M1-S0",
    "city": "Paris",
    "latitude": 48.85,
    "longitude": 2.35,
    "line": "M1",
    "timestamp": 1_700_000_000_000,
    "hour": 12,
    "day_of_week": 3,
    "month": 6,
    "pm25": 10,
    "pm10": 20,
    "co2": 400,
    "no2": 20,
    "o3": 30,
    "noise": 50,
    "humidity": 60,
    "temperature": 20,
    "wind_speed": 3.0,
    "rain": 0,
}


def readings(spark, *rows: dict):
    """Readings DataFrame from partial rows (missing fields take BASE values)."""
    data = [tuple({**BASE, **r}.get(f.name) for f in READINGS.fields) for r in rows]
    return spark.createDataFrame(data, READINGS)
