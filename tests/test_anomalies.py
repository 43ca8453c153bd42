"""Statistical detectors on tiny tables: constant columns, one row, empty input, quantiles."""

from fixture_rows import readings
from smogmesh.operators import anomalies as an
from smogmesh.operators import explore as ex
from smogmesh.operators import stations as st


def test_zscore_constant_column_is_not_an_anomaly(spark):
    # std = 0 gives null z, no division error, no anomaly.
    df = readings(spark, {}, {})
    assert an.zscore(df).count() == 0
    row = an.with_zscores(df).collect()[0]
    assert row["z_pm25"] is None


def test_zscore_single_row_and_empty(spark):
    assert an.zscore(readings(spark, {})).count() == 0
    empty = readings(spark, {}).limit(0)
    assert an.zscore(empty).count() == 0


def test_zscore_flags_outlier_by_first_column(spark):
    rows = [{"pm25": 10, "pm10": 20}] * 30 + [{"pm25": 500, "pm10": 900}]
    got = an.zscore(readings(spark, *rows)).collect()
    assert len(got) == 1 and got[0]["anomalie_zscore"] == "PM2.5_OUTLIER"


def test_correlation_constant_column_is_null(spark):
    # A constant column gives null, not an error.
    df = readings(spark, {"pm25": 1, "pm10": 5}, {"pm25": 2, "pm10": 5}, {"pm25": 3, "pm10": 5})
    row = ex.correlations(df, others=("pm10", "co2")).collect()[0]
    assert row["pm10"] is None


def test_correlation_pairwise_rows(spark):
    df = readings(
        spark,
        {"pm25": 1, "no2": 2},
        {"pm25": 2, "no2": 4},
        {"pm25": 3, "no2": 6},
        {"pm25": None, "no2": 100},
        {"pm25": 100, "no2": None},
    )
    row = ex.correlations(df, others=("no2",)).collect()[0]
    assert abs(row["no2"] - 1.0) < 1e-12


def test_quartiles_exact(spark):
    # 1..5 with nulls, and all equal values.
    df = readings(spark, *[{"pm25": v} for v in (1, 2, 3, 4, 5, None, None)])
    f = an.quartile_fences(df).collect()[0]
    assert (f.q1, f.q3) == (2.0, 4.0)
    assert (f.lower, f.upper) == (-1.0, 7.0)
    same = readings(spark, *[{"pm25": 7}] * 4)
    f = an.quartile_fences(same).collect()[0]
    assert (f.q1, f.q3, f.iqr) == (7.0, 7.0, 0.0)
    assert an.iqr(same).count() == 0


def test_iqr_both_fences(spark):
    rows = [{"pm25": v} for v in (10, 11, 12, 13, 14, 15, 16, 17)] + [{"pm25": 100}, {"pm25": -50}]
    got = sorted(r.pm25 for r in an.iqr(readings(spark, *rows)).collect())
    assert got == [-50, 100]


def test_summary_one_pass_counts(spark):
    rows = [{"pm25": 10}] * 20 + [{"pm25": 80}, {"hour": 8, "pm25": 0}]
    got = {r.method: r.anomalies for r in an.summary(readings(spark, *rows)).collect()}
    assert got["fixed_limits"] == 1
    assert got["context"] == 1
    assert got["iqr"] == 2


def test_fold_equals_reduce_and_empty_input(spark):
    df = readings(spark, {"pm25": 25}, {"pm25": None}, {"pm25": 50})
    row = st.network_total(df).collect()[0]
    assert abs(row.total - row.total_fold) < 1e-12 and row.n_readings == 3
    empty = st.network_total(df.limit(0)).collect()[0]
    assert empty.total is None and empty.total_fold == 0.0 and empty.mean_index is None


def test_station_ranking_ties_by_key(spark):
    # Equal means, key decides.
    df = readings(
        spark,
        {"station_id": 2, "station_name": "b"},
        {"station_id": 1, "station_name": "a"},
        {"station_id": 3, "station_name": "c", "pm25": 100},
    )
    got = [r.station_id for r in st.station_ranking(df, k=2).collect()]
    assert got == [3, 1]
