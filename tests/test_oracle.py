"""Every registered query against its DuckDB oracle on the smallest test tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from smogmesh.plans import catalog
from fixture_rows import SF_SMALL

TABLES = ("region", "events")
QUERIES = catalog.queries()
ORACLES = catalog.oracle_sql()


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v.is_integer() else round(v, 9)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    got = _rows(QUERIES[key](spark, SF_SMALL).toPandas())
    want = _rows(con.sql(ORACLES[key]).df())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_every_query_has_an_oracle_except_models():
    assert set(QUERIES) - set(ORACLES) == {"model_metrics", "best_model", "feature_importance", "predictions"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() == 24
