"""Exact selection against sorting, for all kinds of values and groups; rank sketches against exact counts."""

import math
import random

import pytest
from pyspark.sql import functions as F

from smogmesh.operators import anomalies, graph
from smogmesh.operators import quantiles as qu

PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)


def disc(values, p):
    values = sorted(values)
    return next(v for i, v in enumerate(values) if (i + 1) / len(values) >= p)


def linear(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    lo, hi = values[math.floor(at)], values[math.ceil(at)]
    return lo if lo == hi else (math.ceil(at) - at) * lo + (at - math.floor(at)) * hi


def columns():
    r = random.Random(2)
    return {
        "whole": [r.randrange(-50, 50) for _ in range(500)],
        "continuous": [r.gauss(0, 1) for _ in range(800)],
        "scales": [r.choice((-1, 1)) * 10.0 ** r.uniform(-300, 300) for _ in range(400)],
        "near": [1.0 + i * 2.0**-52 for i in range(300)],
        "tiny": [5e-324 * i for i in range(40)] + [0.0, -0.0],
        "one_value": [7.25] * 90,
        "hot_value": [3.0] * 900 + [r.random() for _ in range(100)],
        "ends": [float("inf")] * 3 + [float("-inf")] * 3 + [1.0, 2.0, 1.7e308, -1.7e308],
        "single": [4.5],
    }


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double").repartition(4)


@pytest.mark.parametrize("name", sorted(columns()))
def test_equals_sorting(spark, name):
    values = [float(v) for v in columns()[name]]
    df = frame(spark, values)
    row = qu.exact_quantiles(df, "x", PROBS, bins=16).first()
    assert row["n"] == len(values)
    assert [row[f"q{i}"] for i in range(len(PROBS))] == [disc(values, p) for p in PROBS]
    if all(map(math.isfinite, values)):
        row = qu.exact_quantiles(df, "x", PROBS, bins=16, interpolate=True).first()
        for i, p in enumerate(PROBS):
            assert math.isclose(row[f"q{i}"], linear(values, p), rel_tol=1e-12, abs_tol=0)


@pytest.mark.parametrize("broadcast_groups", [100_000, 0])
def test_all_groups_at_once(spark, broadcast_groups):
    # One group holds most rows; a null key is a group; a group without values is left out.
    groups = {name: [float(v) for v in vs] for name, vs in columns().items() if name != "ends"}
    groups["hot"] = [random.Random(5).random() for _ in range(4000)]
    groups[None] = [1.0, 2.0, 10.0]
    rows = [(g, i % 2, v) for g, vs in groups.items() for i, v in enumerate(vs)] + [("empty", 0, None), ("empty", 1, float("nan"))]
    df = spark.createDataFrame(rows, "g string, part int, x double").repartition(6)
    got = {r["g"]: r for r in qu.exact_quantiles(df, "x", (0.25, 0.75), by=("g",), bins=64, broadcast_groups=broadcast_groups).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert (got[g]["n"], got[g]["q0"], got[g]["q1"]) == (len(vs), disc(vs, 0.25), disc(vs, 0.75))
    two = qu.exact_quantiles(df, "x", (0.5,), by=("g", "part"), interpolate=True, broadcast_groups=broadcast_groups)
    for r in two.collect():
        vs = [v for g, p, v in rows if (g, p) == (r["g"], r["part"]) and v is not None and not math.isnan(v)]
        assert math.isclose(r["q0"], linear(vs, 0.5), rel_tol=1e-12, abs_tol=1e-300)


def test_no_values(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert qu.exact_quantiles(empty, "x", (0.5,)).count() == 0
    assert qu.exact_quantiles(empty.withColumn("g", F.lit(1)), "x", (0.5,), by=("g",)).count() == 0
    for exact in (True, False):
        assert tuple(anomalies.quartile_fences(empty, "x", exact=exact).first()) == (None,) * 5
    assert anomalies.quartile_rank_errors(empty, "x").count() == 0
    with pytest.raises(ValueError):
        qu.exact_quantiles(empty, "x", (1.5,))


def test_cells_and_bins_keep_the_order(spark):
    values = sorted(float(v) for v in columns()["scales"] + columns()["near"] + columns()["continuous"])
    rows = frame(spark, values).filter(F.col("x").isNotNull() & ~F.isnan("x")).select("x", qu._cell(F.col("x")).alias("c"))
    cells = [r["c"] for r in sorted(rows.collect(), key=lambda r: r["x"])]
    assert cells == sorted(cells)
    lo, hi = 1.0, 1.0 + 299 * 2.0**-52
    bins = [r["b"] for r in frame(spark, columns()["near"]).filter("x is not null and not isnan(x)").orderBy("x").select(qu._bin(F.col("x"), F.lit(lo), F.lit(hi), 16).alias("b")).collect()]
    assert bins == sorted(bins) and (bins[0], bins[-1]) == (0, 15)


def test_memory_is_bounded_by_cells_and_bins(spark, monkeypatch):
    """What a pass gathers does not grow with the distinct values."""
    seen = []
    plain = qu.cut_lineage
    monkeypatch.setattr(qu, "cut_lineage", lambda df: seen.append(plain(df)) or seen[-1])
    df = spark.range(60_000).select((F.col("id") * 0.61803398875 % 1.0 + 1.0).alias("x"))
    values = sorted(r["x"] for r in df.collect())
    assert qu.exact_quantiles(df, "x", (0.5,)).first()["q0"] == disc(values, 0.5)
    assert max(t.count() for t in seen) <= 70  # one octave: 64 cells


def test_upper_quartile_in_one_city(spark):
    v = spark.range(5000).select(
        "id", F.concat(F.lit("s"), "id").alias("name"), F.lit("Big").alias("city"), (F.col("id") * 0.37 % 11).cast("double").alias("pollution")
    )
    more = spark.createDataFrame([(9001, "a", "Small", 1.0), (9002, "b", "Small", None), (9003, "c", None, 5.0), (9004, "d", "None", None)], "id long, name string, city string, pollution double")
    got = {r["id"]: r for r in graph.upper_quartile_stations(v.unionByName(more)).collect()}
    want = linear([r["pollution"] for r in v.collect()], 0.75)
    assert math.isclose(got[0]["threshold"], want, rel_tol=1e-12)
    marked = {i for i, r in got.items() if r["city"] == "Big" and r["highlighted"]}
    assert marked == {r["id"] for r in v.collect() if r["pollution"] > got[0]["threshold"]} and 1100 < len(marked) < 1300
    assert (got[9001]["threshold"], got[9001]["highlighted"], got[9002]["highlighted"]) == (1.0, False, None)
    assert 9003 not in got and got[9004]["threshold"] is None


@pytest.mark.parametrize("name", ["continuous", "hot_value", "scales", "single"])
def test_sketches_keep_their_error(spark, name):
    values = [float(v) for v in columns()[name]] * 20
    df = frame(spark, values).withColumn("day", F.spark_partition_id() % 3)
    daily = qu.rank_sketches(df, "x", by=("day",))
    merged = qu.merged_sketches(daily)
    row = qu.sketch_quantiles(merged, (0.05, 0.25, 0.5, 0.75, 0.95)).first()
    assert row["n"] == len(values)
    answers = [(p, row[f"q{i}"]) for i, p in enumerate((0.05, 0.25, 0.5, 0.75, 0.95))]
    for r in qu.rank_errors(df, "x", answers).collect():
        below, at_most = sum(v < r["value"] for v in values), sum(v <= r["value"] for v in values)
        assert (r["n"], r["below"], r["at_most"]) == (len(values), below, at_most)
        want = max(0.0, below / len(values) - r["prob"], r["prob"] - at_most / len(values))
        assert math.isclose(r["rank_error"], want, abs_tol=1e-12) and want <= 0.01
