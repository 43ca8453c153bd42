"""Models: fits and metrics, an engine-independent split, ridge against Spark ML, trees replayed by SQL."""

import hashlib
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fixture_rows import SF_SMALL
from smogmesh.operators import clean as cl
from smogmesh.operators import regress as rg
from smogmesh.operators import ridge as rd
from smogmesh.schema import FEATURES
from smogmesh.sources.readings import readings_view


@pytest.fixture(scope="module")
def cleaned(spark):
    return cl.clean(readings_view(spark, SF_SMALL)).persist()


@pytest.fixture(scope="module")
def fitted(cleaned):
    out = rg.fit_models(cleaned)
    yield out
    out.release()


def test_split_is_partitioning_independent(spark, cleaned):
    a, _ = rg.split(cleaned)
    b, _ = rg.split(cleaned.repartition(7))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_row_draw_is_an_md5_of_a_plain_text(spark):
    rows = [(1, "a", 0.1, True), (None, "", None, False), (2, None, -1.5, None), (3, "é", 1e300, True), (4, "x", float("nan"), True), (5, "y", float("-inf"), True)]
    df = spark.createDataFrame(rows, "i int, s string, x double, b boolean")

    def text(r):
        i, s, x, b = r
        if x is None:
            t = "\0"
        elif math.isnan(x):
            t = "nan"
        else:
            t = str(math.floor(x * 1e6 + 0.5)) if abs(x) < 1e12 else "far" if x > 0 else "-far"
        return "\x1f".join("\0" if v is None else v for v in (None if i is None else str(i), s, t, None if b is None else str(b).lower()))

    want = [int(hashlib.md5(f"42:{text(r)}".encode()).hexdigest()[:8], 16) % 10_000 for r in rows]
    got = [r["d"] for r in df.coalesce(1).select(rg.row_draw(df).alias("d")).collect()]
    assert got == want


def test_fit_models_and_metrics(spark, fitted):
    table = {r.model: r for r in rg.model_metrics(fitted).collect()}
    assert set(table) == set(rg.MODEL_NAMES)
    for r in table.values():
        assert r.rmse >= 0 and r.mae >= 0 and r.r2 <= 1.0
    best = rg.best_model(rg.model_metrics(fitted)).collect()[0]
    assert best.r2 == max(r.r2 for r in table.values())
    imp = rg.feature_importance(spark, fitted).collect()
    assert [x["rank"] for x in imp] == list(range(1, 11)) and all(x.importance_pct >= 0 for x in imp)
    assert [x.importance_pct for x in imp] == sorted((x.importance_pct for x in imp), reverse=True)


def test_split_sizes_match_split(spark, cleaned):
    row = rg.split_sizes(cleaned).collect()[0]
    train, test = rg.split(rg.prepare(cleaned))
    assert (row.n_train, row.n_test) == (train.count(), test.count())
    assert row.n_rows == row.n_train + row.n_test == cleaned.count()


def test_ridge_equals_the_library(cleaned, fitted):
    own, rows = rg.ridge(cleaned)
    theirs = fitted.models["linear_regression"]
    assert np.allclose(own.coefficients, theirs.coefficients.toArray(), atol=1e-6)
    assert math.isclose(own.intercept, theirs.intercept, abs_tol=1e-6)
    assert own.gradient < 1e-10 and own.n == rows.filter("is_train").count()
    mine = sorted(r["prediction"] for r in own.predict(rows.filter("not is_train")).collect())
    want = sorted(r["prediction"] for r in rg.predictions(fitted, "linear_regression").collect())
    assert np.allclose(mine, want, atol=1e-6)


def test_ridge_on_hard_tables(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(400, 3)) * [1.0, 1e-4, 1e4] + [0.0, 5.0, 1e7]
    y = x @ [2.0, 3e4, -1e-4] + 7 + 0.1 * r.normal(size=400)
    rows = [(*map(float, v), 9.0, float(v[0]), float(t)) for v, t in zip(x, y)] + [(None, 1.0, 1.0, 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, 1.0, 1.0, None)]
    names = ["a", "b", "c", "constant", "twin"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in [*names, "label"])).repartition(5)
    got = rd.fit_ridge(df, names, reg=0.05)
    # Dense solution of the same objective.
    m = np.column_stack([x, np.full(400, 9.0), x[:, 0]])
    sd = m.std(axis=0)
    live = [0, 1, 2, 4]
    z = (m[:, live] - m[:, live].mean(axis=0)) / sd[live]
    w = np.linalg.solve(z.T @ z / 400 + 0.05 / y.std() * np.eye(4), z.T @ (y - y.mean()) / 400)
    want = np.zeros(5)
    want[live] = w / sd[live]
    assert got.n == 400 and got.coefficients[3] == 0.0
    assert np.allclose(got.coefficients, want, rtol=1e-6)
    assert math.isclose(got.intercept, y.mean() - want @ m.mean(axis=0), rel_tol=1e-6)
    flat = rd.fit_ridge(df.withColumn("label", F.lit(3.0)), names)
    assert (set(flat.coefficients), flat.intercept) == ({0.0}, 3.0)
    assert rd.fit_ridge(df.filter("false"), names) is None


@pytest.mark.parametrize("name", ["decision_tree", "random_forest"])
def test_trees_replayed_by_sql(spark, fitted, name):
    """Every leaf as a conjunction of conditions, run by another engine over the same feature rows."""
    model = fitted.models[name]
    leaves = rg.tree_leaves(spark, model).collect()
    n_trees = len(model.trees) if name == "random_forest" else 1
    nodes = sum(t.numNodes for t in model.trees) if n_trees > 1 else model.numNodes
    assert len({x["tree"] for x in leaves}) == n_trees and len(leaves) == (nodes + n_trees) // 2
    rows = rg.predictions(fitted, name).withColumn("row_id", F.monotonically_increasing_id()).persist()
    con = duckdb.connect()
    con.register("cells", rg.feature_cells(rows).toPandas())
    con.register("conditions", rg.leaf_conditions(rg.tree_leaves(spark, model)).toPandas())
    got = con.sql(rg.REPLAY_SQL).df().sort_values("row_id")
    want = rows.select("row_id", "prediction").toPandas().sort_values("row_id")
    assert (got["n_leaves"] == n_trees).all() and len(got) == len(want)
    assert np.allclose(got["prediction"], want["prediction"], atol=1e-9)
    # And as one expression in Spark.
    again = rg.feature_rows(rows, "prediction").withColumn("again", rg.replay_column(leaves)).toPandas()
    assert len(again) == len(want) and np.allclose(again["again"], again["prediction"], atol=1e-9)


def test_each_row_meets_one_leaf_of_a_tree(spark, fitted):
    leaves = rg.tree_leaves(spark, fitted.models["decision_tree"]).collect()
    rows = rg.feature_rows(fitted.test.withColumn("is_train", F.lit(False))).collect()

    def holds(row, c):
        v = row[c["feature"]]
        return v in c["categories"] if c["op"] == "in" else v <= c["value"] if c["op"] == "<=" else v > c["value"]

    for r in rows[:200]:
        assert sum(all(holds(r, c) for c in x["conditions"]) for x in leaves) == 1


def test_categories_are_counted_in_one_pass_as_string_indexers_do(spark):
    from pyspark.ml.feature import StringIndexer

    rows = [("b", "x"), ("a", "x"), (None, "y"), ("c", None), ("c", "\U0001F600"), ("c", "\uFF5E"), ("", "y")]
    seen = spark.sparkContext.accumulator(0)

    def note(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame(rows, "line string, city string").mapInArrow(note, "line string, city string")
    model = rg.feature_stages(df)
    assert seen.value == len(rows)
    for s in model.stages[:2]:
        want = StringIndexer(inputCol=s.getInputCol(), handleInvalid="keep").fit(df)
        assert list(s.labels) == list(want.labels) and s.getHandleInvalid() == "keep"
    assert [list(s.labels) for s in rg.feature_stages(df.filter("line = 'z'")).stages[:2]] == [[], []]
