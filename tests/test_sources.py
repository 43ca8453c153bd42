"""CSV reader: fixed schema with blank fields as null, and the inference option."""

import tempfile

from fixture_rows import readings
from smogmesh.schema import READINGS
from smogmesh.sources.readings import accepted, line_report, load_readings, read_readings, rejected, write_readings_csv


def test_csv_round_trip_keeps_nulls_and_types(spark):
    df = readings(spark, {"pm25": None, "wind_speed": None}, {"station_id": 2, "pm25": 90})
    path = tempfile.mkdtemp(prefix="smogmesh-csv-test-") + "/r"
    write_readings_csv(df, path)
    back = load_readings(spark, path)
    assert back.schema == READINGS
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    inferred = load_readings(spark, path, infer=True)
    types = dict(inferred.dtypes)
    assert types["station_id"] == "int" and types["timestamp"] == "bigint" and types["wind_speed"] == "double"


def test_rejected_lines_are_kept_and_counted(spark, tmp_path):
    good = "1,Paris-M1-S0,Paris,48.85,2.35,M1,1700000000000,12,3,6,10,20,400,20,30,50,60,20,3.0,0"
    lines = [
        good,
        good.replace(",10,20,400,", ",,20,400,"),  # a blank field is null, not an error
        ",".join(good.split(",")[:-1]),  # one field too few
        good + ",9",  # one too many
        good.replace(",12,3,6,", ",noon,3,6,"),  # a word for a number
        good.replace("Paris-M1-S0", '"a, b, c"'),  # commas inside quotes
        good.replace("Paris-M1-S0", '"a, b"').replace(",12,3,6,", ",noon,3,6,"),
    ]
    (tmp_path / "r.csv").write_text("\n".join([",".join(READINGS.names), *lines]) + "\n")
    rows = read_readings(spark, str(tmp_path))
    assert accepted(rows).schema == READINGS
    assert {(r["station_name"], r["pm25"]) for r in accepted(rows).collect()} == {("Paris-M1-S0", 10), ("Paris-M1-S0", None), ("a, b, c", 10)}
    bad = {r["_corrupt_record"]: r for r in rejected(rows).collect()}
    assert {t: r["reason"] for t, r in bad.items()} == {lines[2]: "short", lines[3]: "long", lines[4]: "value", lines[6]: "value"}
    assert (bad[lines[4]]["hour"], bad[lines[4]]["pm25"], bad[lines[3]]["rain"]) == (None, 10, 0)
    got = {r["reason"]: (r["rows"], r["with_station"]) for r in line_report(rows).collect()}
    assert got == {None: (3, 3), "short": (1, 1), "long": (1, 1), "value": (2, 2)}
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "r.csv").write_text(",".join(READINGS.names) + "\n")
    assert line_report(read_readings(spark, str(tmp_path / "none"))).count() == 0
