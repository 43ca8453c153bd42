"""Graph operators against brute force on small graphs."""

import random

import numpy as np
from pyspark.sql import functions as F

from fixture_rows import readings
from smogmesh.operators import graph as gr


def _edges_df(spark, pairs):
    return spark.createDataFrame([(int(a), int(b), "L", "C") for a, b in pairs], "src long, dst long, line string, city string")


def _vertices_df(spark, ids, pollution=None):
    pollution = pollution or {i: float(i % 7) / 3.0 for i in ids}
    rows = [(int(i), f"s{i}", "C", 0.0, 0.0, pollution[i], ["L"]) for i in ids]
    return spark.createDataFrame(
        rows, "id long, name string, city string, latitude double, longitude double, pollution double, lines array<string>"
    )


def _union_find(ids, pairs):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    comps = {}
    for i in ids:
        comps.setdefault(find(i), []).append(i)
    return {i: min(members) for members in comps.values() for i in members}


def test_components_match_union_find_on_shuffled_chains(spark):
    rng = random.Random(7)
    ids = list(range(1, 400))
    perm = ids[:]
    rng.shuffle(perm)
    pairs = []
    # three long chains with shuffled ids, a star, isolated vertices
    for chunk in (perm[0:150], perm[150:260], perm[260:330]):
        pairs += list(zip(chunk, chunk[1:]))
    pairs += [(perm[330], x) for x in perm[331:350]]
    pairs += [(perm[5], perm[7])]  # a cycle inside the first chain
    v, e = _vertices_df(spark, ids), _edges_df(spark, pairs)
    got = {r.id: r.component for r in gr.components(v, e).collect()}
    assert got == _union_find(ids, pairs)


def test_propagation_matches_closed_form(spark):
    ids = list(range(10))
    pairs = [(0, 1), (1, 2), (2, 3), (0, 1), (4, 5), (5, 6), (6, 4)]  # a parallel edge and a triangle
    x0 = {i: 0.1 * (i + 1) for i in ids}
    v, e = _vertices_df(spark, ids, x0), _edges_df(spark, pairs)
    got = {r.id: r.propagated for r in gr.propagate(v, e).collect()}
    a = np.zeros((10, 10))
    for s, d in pairs:
        a[s, d] += 1
        a[d, s] += 1
    want = np.linalg.matrix_power(np.eye(10) + 0.1 * a, 5) @ np.array([x0[i] for i in ids])
    assert max(abs(got[i] - want[i]) for i in ids) < 1e-12
    assert got[9] == x0[9]  # isolated vertex unchanged


def test_degree_sum_and_criticality(spark):
    pairs = [(1, 2), (2, 3), (1, 2)]
    v, e = _vertices_df(spark, [1, 2, 3, 4]), _edges_df(spark, pairs)
    deg = {r.id: r.degree for r in gr.degrees(e).collect()}
    assert deg == {1: 2, 2: 3, 3: 1}  # parallel edge counted twice, vertex 4 absent
    assert sum(deg.values()) == 2 * len(pairs)
    crit = {r.id for r in gr.criticality(v, e).collect()}
    assert crit == {1, 2, 3}


def test_edges_from_readings_one_station_line_and_same_name_two_cities(spark):
    df = readings(
        spark,
        {"station_id": 3, "line": "M1", "city": "A"},
        {"station_id": 1, "line": "M1", "city": "A"},
        {"station_id": 2, "line": "M1", "city": "A"},
        {"station_id": 10, "line": "M1", "city": "B"},  # same line name, other city
        {"station_id": 11, "line": "M1", "city": "B"},
        {"station_id": 20, "line": "solo", "city": "A"},  # one-station line: no edge
        {"station_id": 1, "line": "M2", "city": "A"},  # second line over 1-2: parallel edge
        {"station_id": 2, "line": "M2", "city": "A"},
    )
    got = sorted((r.src, r.dst, r.line, r.city) for r in gr.edges(df).collect())
    assert got == [(1, 2, "M1", "A"), (1, 2, "M2", "A"), (2, 3, "M1", "A"), (10, 11, "M1", "B")]


def test_vertices_conflicting_station_rows_pick_smallest_key(spark):
    # One station id with two coordinates gives one deterministic vertex.
    df = readings(
        spark,
        {"station_id": 1, "latitude": 2.0, "line": "M1"},
        {"station_id": 1, "latitude": 1.0, "line": "M2", "pm25": 50},
        {"station_id": 1, "latitude": 1.0, "line": "M1", "pm25": 50},
    )
    rows = gr.vertices(df).collect()
    assert len(rows) == 1
    assert rows[0].latitude == 1.0 and rows[0].lines == ["M1", "M2"]


def test_city_views(spark):
    v = _vertices_df(spark, [1, 2, 3]).withColumn("city", F.when(F.col("id") == 3, "D").otherwise("C"))
    e = spark.createDataFrame([(1, 2, "L", "C"), (2, 3, "L", "C")], "src long, dst long, line string, city string")
    got = [(r.source, r.target) for r in gr.city_edges(v, e).collect()]
    assert got == [(1, 2)]  # edge 2-3 leaves the city
    summary = {r.city: (r.n_nodes, r.n_edges) for r in gr.city_summary(v, e).collect()}
    assert summary == {"C": (2, 1), "D": (1, 0)}
