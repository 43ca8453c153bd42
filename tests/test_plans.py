"""Physical-plan properties: filters reach the scan, no cross products anywhere."""

import pytest

from fixture_rows import SF_SMALL
from smogmesh.operators import profiles
from smogmesh.plans import catalog
from smogmesh.sources.readings import readings_view

QUERIES = catalog.queries()
MODELS = {"model_metrics", "best_model", "feature_importance", "predictions", "trees_replayed", "feature_rows", "ridge_predictions", "ridge_metrics"}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A stored readings table, as a user would have it."""
    path = str(tmp_path_factory.mktemp("readings") / "readings")
    readings_view(spark, SF_SMALL).write.parquet(path)
    return spark.read.parquet(path)


def _plan(df) -> str:
    # The "formatted" explain text lists every scan's pushed filters in full.
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_filter_reaches_parquet_scan(stored):
    plan = _plan(profiles.high_readings(stored))
    assert "PushedFilters: [" in plan and "GreaterThan(pm25,70)" in plan


def test_profile_reads_only_needed_columns(stored):
    plan = _plan(profiles.hourly_profile(stored))
    assert "ReadSchema: struct<hour:int,pm25:int,pm10:int,co2:int,no2:int,o3:int,noise:int>" in plan


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k not in MODELS))
def test_no_cross_products(spark, key):
    plan = _plan(QUERIES[key](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
