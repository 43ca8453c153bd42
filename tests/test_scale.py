"""Behaviour that must not depend on size: hubs, long lines, changed input, many categories, scratch folders."""

import pytest
from pyspark.sql import functions as F

from smogmesh.operators import clean, graph, regress
from smogmesh.session import checkpoint_root
from smogmesh.sources.readings import readings_view
from fixture_rows import SF_SMALL


def test_source_change_is_seen(spark, tmp_path):
    for name in ("events", "region"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    before = readings_view(spark, str(tmp_path)).count()
    half = spark.read.parquet(f"{SF_SMALL}/events.parquet").filter("event_id % 2 = 0")
    half.write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
    assert 0 < readings_view(spark, str(tmp_path)).count() < before


class _Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None

    def getConf(self):
        return {}


class _Session:
    def __init__(self, master):
        self.sparkContext, self.conf = _Context(master), {}


def test_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError):
        checkpoint_root(_Session("spark://host:7077"))


def test_star_and_chain_components(spark):
    star = spark.range(1, 20_001).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    chain = spark.range(30_000, 30_999).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    e = star.unionByName(chain)
    v = spark.range(0, 20_002).unionByName(spark.range(30_000, 31_000))
    got = {r["component"]: r["count"] for r in graph.components(v, e).groupBy("component").count().collect()}
    assert got == {0: 20_001, 20_001: 1, 30_000: 1_000}


@pytest.mark.parametrize("width", [1, 7, 10**9])
def test_edges_do_not_depend_on_bucket_width(spark, width):
    rows = spark.createDataFrame(
        [("L1", i, "X") for i in (0, 1, 5, 6, 7, 40, 41, 99)] + [("L1", 3, "Y"), ("L2", 8, "Y"), ("L2", 70, "Y")],
        "line string, station_id int, city string",
    )
    got = sorted(tuple(r) for r in graph.edges(rows, width=width).collect())
    line = [0, 1, 5, 6, 7, 40, 41, 99]
    assert got == sorted([(a, b, "L1", "X") for a, b in zip(line, line[1:])] + [(8, 70, "L2", "Y")])


def test_inventory_tells_null_city_from_total(spark):
    rows = spark.createDataFrame(
        [("A", "L1", 1), ("A", "L2", 1), (None, "L1", 2), (None, "L1", 2)], "city string, line string, station_id int"
    )
    got = {(r["city"], r["is_total"]): (r["n_lines"], r["n_stations"], r["n_readings"]) for r in clean.network_inventory(rows).collect()}
    assert got == {("A", False): (2, 1, 2), (None, False): (1, 1, 2), (None, True): (2, 2, 4)}


def test_models_fit_many_lines(spark):
    rows = readings_view(spark, SF_SMALL).withColumn("line", F.concat(F.lit("L"), (F.col("station_id") * 7 + F.col("hour")) % 45))
    fitted = regress.fit_models(clean.clean(rows), names=("decision_tree",))
    assert "decision_tree" in fitted.models
    fitted.test.unpersist()


def test_edges_keep_null_lines_and_cities(spark):
    rows = spark.createDataFrame(
        [("L1", 1, None), ("L1", 2, None), ("L1", 30, None), (None, 4, "A"), (None, 5, "A"), (None, 6, None), (None, 7, None), ("L1", None, "A"), ("L1", 9, "A")],
        "line string, station_id int, city string",
    )
    want = [(1, 2, "L1", None), (2, 30, "L1", None), (4, 5, None, "A"), (6, 7, None, None)]
    for width in (1, 10, 10_000):
        assert sorted(map(tuple, graph.edges(rows, width=width).collect()), key=str) == sorted(want, key=str)


def test_a_hub_is_cut_into_parts(spark):
    """A star: no part holds many more edges than the limit, and the result is that of the plain sum."""
    leaves = 30_000
    e = spark.range(1, leaves + 1).select(F.lit(0).cast("long").alias("src"), F.col("id").alias("dst"))
    v = spark.range(0, leaves + 1).select(
        "id", F.lit("n").alias("name"), F.lit("c").alias("city"), F.when(F.col("id") == 0, 2.0).otherwise(1.0).alias("pollution")
    )
    adj = graph.both_directions(e)
    hubs = graph.hub_parts(adj, hub_degree=1000)
    assert [tuple(r) for r in hubs.collect()] == [(0, 30)]
    sizes = [r["count"] for r in graph.cut_hubs(adj, hubs).filter("src = 0").groupBy("part").count().collect()]
    assert len(sizes) == 30 and sum(sizes) == leaves and max(sizes) <= 2 * sorted(sizes)[15]
    got = {r["id"]: r["propagated"] for r in graph.propagate(v, e, rounds=2, factor=0.1, hub_degree=1000).filter("id < 3").collect()}
    hub, leaf = 2.0, 1.0
    for _ in range(2):
        hub, leaf = hub + 0.1 * leaves * leaf, leaf + 0.1 * hub
    assert abs(got[0] - hub) < 1e-6 and abs(got[1] - leaf) < 1e-9 and got[1] == got[2]
    whole = graph.propagate(v, e, rounds=2, factor=0.1).filter("id < 3").collect()
    assert all(abs(r["propagated"] - got[r["id"]]) < 1e-6 for r in whole)


@pytest.mark.parametrize("parts", [1, 13])
def test_export_files_follow_the_rows(spark, tmp_path, parts):
    v = spark.range(1000).select(
        "id", F.concat(F.lit("s"), "id").alias("name"), F.when(F.col("id") < 900, "Big").otherwise(F.concat(F.lit("c"), F.col("id") % 5)).alias("city"),
        F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"), F.lit(0.5).alias("pollution"), F.array(F.lit("L")).alias("lines"),
    ).repartition(parts)
    e = spark.range(1, 900).select((F.col("id") - 1).alias("src"), F.col("id").alias("dst"), F.lit("L").alias("line"), F.lit("Big").alias("city")).repartition(parts)
    graph.export_network(v, e, str(tmp_path), rows_per_file=100)
    found = {d.name: sorted(sum(1 for _ in f.open()) for f in d.glob("*.json")) for d in (tmp_path / "nodes").iterdir() if d.is_dir()}
    assert {k: sum(n) for k, n in found.items()} == {"city=Big": 900, **{f"city=c{i}": 20 for i in range(5)}}
    assert all(len(found[f"city=c{i}"]) == 1 for i in range(5))
    assert 5 <= len(found["city=Big"]) <= 9 and max(found["city=Big"]) <= 200
    assert len(list((tmp_path / "edges" / "city=Big").glob("*.json"))) <= 9
    _EXPORTED.append({k: n for k, n in found.items()})
    assert all(x == _EXPORTED[0] for x in _EXPORTED)  # the same files from any number of partitions


_EXPORTED: list = []


def test_components_of_a_long_chain_and_a_shuffled_ring(spark):
    n = 4000
    ring = [((i * 1237) % n, ((i + 1) * 1237) % n) for i in range(n)]
    e = spark.createDataFrame(ring, "src long, dst long").unionByName(spark.range(n, n + 700).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst")))
    got = {r["component"]: r["count"] for r in graph.components(spark.range(n + 702), e).groupBy("component").count().collect()}
    assert got == {0: n, n: 701, n + 701: 1}
