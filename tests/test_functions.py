"""Column builders and rule tables on tiny hand-made rows (null, order and edge cases)."""

from pyspark.sql import functions as F

from fixture_rows import readings
from smogmesh.functions import period_label, severity, split_keep_leading, weekday_name, who_index
from smogmesh.operators import anomalies as an
from smogmesh.operators import profiles as pr


def _index(pm25, pm10, co2, no2, o3):
    return ((pm25 / 25) * 3 + (pm10 / 50) * 2 + (co2 / 1000) * 0.5 + (no2 / 40) * 2 + (o3 / 100) * 1) / 8.5


def test_who_index_value_and_null_policies(spark):
    df = readings(spark, {"pm25": 25}, {"pm25": None})
    got = df.select(who_index(nulls="null").alias("a"), who_index(nulls="zero").alias("b")).collect()
    full = _index(25, 20, 400, 20, 30)
    assert abs(got[0]["a"] - full) < 1e-12 and abs(got[0]["b"] - full) < 1e-12
    assert got[1]["a"] is None  # N1: column form gives null
    assert abs(got[1]["b"] - _index(0, 20, 400, 20, 30)) < 1e-12  # row form reads null as 0


def test_profile_counts_null_index_rows_but_mean_skips_them(spark):
    # count(*) counts the null-index row, avg skips it.
    df = readings(spark, {"pm25": 25}, {"pm25": None})
    row = pr.hourly_profile(df, digits=None).collect()[0]
    assert row["nb_mesures"] == 2
    assert abs(row["pollution_moyenne"] - _index(25, 20, 400, 20, 30)) < 1e-12


def test_fixed_rules_first_match_and_fall_through(spark):
    # One row per rule, one breaking two rules (first wins), one all-null row.
    null_row = {c: None for c in ("pm25", "pm10", "co2", "no2", "o3", "temperature")}
    df = readings(
        spark,
        {"pm25": 80},
        {"pm10": 160},
        {"no2": 110},
        {"o3": 210},
        {"co2": 1600},
        {"temperature": -1},
        {"temperature": 46},
        {"pm25": 80, "co2": 1600},
        null_row,
    )
    labels = [r["anomalie_type"] for r in an.label_fixed(df).collect()]
    assert labels == [
        "PM2.5_CRITIQUE",
        "PM10_CRITIQUE",
        "NO2_CRITIQUE",
        "O3_CRITIQUE",
        "CO2_CRITIQUE",
        "TEMP_IMPOSSIBLE",
        "TEMP_IMPOSSIBLE",
        "PM2.5_CRITIQUE",
        "NORMAL",
    ]
    assert an.fixed_limits(df).count() == 8


def test_severity_bands_and_null(spark):
    # A null index is NORMALE unless an unknown label is asked for.
    df = spark.createDataFrame([(1.5,), (0.7,), (0.5,), (None,)], "x double")
    got = [r[0] for r in df.select(severity(F.col("x"))).collect()]
    assert got == ["DANGER", "ELEVEE", "NORMALE", "NORMALE"]
    got = [r[0] for r in df.select(severity(F.col("x"), unknown_label="INCONNUE")).collect()]
    assert got[-1] == "INCONNUE"


def test_split_like_jvm(spark):
    # Trailing empty parts dropped, leading ones kept, empty string gives one empty part.
    df = spark.createDataFrame([("a-b-S0",), ("a-b--",), ("",), ("---",), ("-a",)], "s string")
    got = [r[0] for r in df.select(split_keep_leading("s")).collect()]
    assert got == [["a", "b", "S0"], ["a", "b"], [""], [], ["", "a"]]


def test_weekday_labels(spark):
    # Outside 1..7 the profile label is Inconnu and the period label is null.
    df = spark.createDataFrame([(1, 8), (7, 23), (0, 5), (8, 1)], "d int, h int")
    got = df.select(weekday_name("d").alias("w"), period_label("d", "h").alias("p")).collect()
    assert [(r.w, r.p) for r in got] == [
        ("Lundi", "Lundi - 8h"),
        ("Dimanche", "Dimanche - 23h"),
        ("Inconnu", None),
        ("Inconnu", None),
    ]


def test_context_rules_hour_five_boundary(spark):
    # pm25 = 31 at hour 5 is flagged (1..5 inclusive), not at hours 0 and 6.
    df = readings(spark, {"hour": 5, "pm25": 31}, {"hour": 0, "pm25": 31}, {"hour": 6, "pm25": 31})
    got = an.context_anomalies(df).select("hour", "anomalie_contexte").collect()
    assert [(r.hour, r.anomalie_contexte) for r in got] == [(5, "POLLUTION_ELEVEE_NUIT")]


def test_context_rule_order(spark):
    df = readings(
        spark,
        {"hour": 8, "pm25": 0, "temperature": 60},  # rush-hour zero wins over temperature
        {"hour": 18, "pm25": 0},
        {"hour": 3, "pm25": 40},
        {"temperature": -11},
        {"temperature": 51},
        {"hour": 12, "pm25": 0},  # zero outside rush hours: fine
    )
    got = [r.anomalie_contexte for r in an.context_anomalies(df).collect()]
    assert got == [
        "POLLUTION_NULLE_POINTE",
        "POLLUTION_NULLE_POINTE",
        "POLLUTION_ELEVEE_NUIT",
        "TEMP_EXTREME",
        "TEMP_EXTREME",
    ]
