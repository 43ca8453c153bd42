"""Station graph: vertices, edges, degree, criticality, propagation, components.

The graph is two DataFrames:

* vertices ``(id, name, city, latitude, longitude, pollution, lines)``: one row
  per station, ``pollution`` the mean index, ``lines`` the sorted set of line names;
* edges ``(src, dst, line, city)``: consecutive stations (by id) of one line in
  one city, ``src < dst``; two lines linking the same pair give two edges.

Iterative operators cut lineage with reliable checkpoints in the session's
checkpoint folder, so a lost executor only costs the current round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogmesh.functions.indices import who_index
from smogmesh.functions.text import lines_text
from smogmesh.operators.quantiles import exact_quantiles
from smogmesh.schema import PROPAGATION_FACTOR, PROPAGATION_ROUNDS
from smogmesh.session import cut_lineage

_VKEY = ("station_id", "station_name", "city", "latitude", "longitude")


# -- construction ------------------------------------------------------------------


def vertices(df: DataFrame, *, nulls: str = "zero") -> DataFrame:
    """One vertex per station: mean index and the set of its lines.

    Readings are first aggregated per (id, name, city, lat, lon); when one id
    has several such keys the smallest key is kept, so the result does not
    depend on partitioning.  The second step only sees one row per key.
    """
    idx = who_index(nulls=nulls)
    per_key = df.groupBy(*_VKEY).agg(
        F.avg(idx).alias("pollution"), F.array_sort(F.collect_set("line")).alias("lines")
    )
    key = F.struct("station_name", "city", "latitude", "longitude")
    pick = F.min_by(F.struct("station_name", "city", "latitude", "longitude", "pollution", "lines"), key)
    return (
        per_key.groupBy("station_id")
        .agg(pick.alias("v"))
        .select(
            F.col("station_id").cast("long").alias("id"),
            F.col("v.station_name").alias("name"),
            F.col("v.city").alias("city"),
            F.col("v.latitude").alias("latitude"),
            F.col("v.longitude").alias("longitude"),
            F.col("v.pollution").alias("pollution"),
            F.col("v.lines").alias("lines"),
        )
    )


def edges(df: DataFrame, *, width: int = 10_000) -> DataFrame:
    """Links between consecutive stations (sorted by id) of each (line, city); one station gives none.

    Station ids fall into buckets of ``width``; a station's follower is the
    next one in its bucket, and the last of a bucket is followed by the first of the
    line's next bucket, found in the table of bucket minima.  A line with any
    number of stations is thus ordered in parallel, with the same result for
    any width.  A null line or city is a group like any other; rows without a
    station id give no edge.
    """
    stations = df.filter("station_id is not null").select("line", "station_id", "city").distinct()
    dealt = stations.withColumn("_b", F.floor(F.col("station_id") / width))
    w = Window.partitionBy("line", "city", "_b").orderBy("station_id")
    inside = dealt.withColumn("_next", F.lead("station_id").over(w))
    firsts = dealt.groupBy("line", "city", "_b").agg(F.min("station_id").alias("_first"))
    over = Window.partitionBy("line", "city").orderBy("_b")
    follow = firsts.select(
        F.col("line").alias("_line"), F.col("city").alias("_city"), F.col("_b").alias("_bucket"),
        F.lead("_first").over(over).alias("_after"),
    )
    same = F.col("line").eqNullSafe(F.col("_line")) & F.col("city").eqNullSafe(F.col("_city")) & (F.col("_b") == F.col("_bucket"))
    # Only the last station of a bucket looks further.
    ends = inside.join(follow, same & F.col("_next").isNull(), "left")
    nxt = F.coalesce("_next", "_after")
    return ends.filter(nxt.isNotNull()).select(
        F.col("station_id").cast("long").alias("src"), nxt.cast("long").alias("dst"), "line", "city"
    )


def both_directions(e: DataFrame) -> DataFrame:
    """Each undirected edge as two directed pairs ``(src, dst)``, one pass over ``e``."""
    pair = F.explode(
        F.array(
            F.struct(F.col("src").alias("a"), F.col("dst").alias("b")),
            F.struct(F.col("dst").alias("a"), F.col("src").alias("b")),
        )
    )
    return e.select(pair.alias("p")).select(F.col("p.a").alias("src"), F.col("p.b").alias("dst"))


def graph_counts(v: DataFrame, e: DataFrame) -> DataFrame:
    """One row: number of vertices and edges."""
    return v.agg(F.count(F.lit(1)).alias("n_vertices")).select(
        "n_vertices", e.agg(F.count(F.lit(1))).scalar().alias("n_edges")
    )


# -- degree and criticality ------------------------------------------------------


def degrees(e: DataFrame) -> DataFrame:
    """In + out degree of every vertex that has an edge (parallel edges count)."""
    return (
        e.select(F.explode(F.array("src", "dst")).alias("id"))
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("degree"))
    )


def _ranked(df: DataFrame, *order) -> DataFrame:
    # Rank numbers over an already limited result (k rows).
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def top_vertices(v: DataFrame, *, k: int = 10) -> DataFrame:
    """The k most polluted stations (ties by id)."""
    order = (F.col("pollution").desc(), F.col("id"))
    return _ranked(v.select("id", "name", "city", "pollution").orderBy(*order).limit(k), *order)


def criticality(v: DataFrame, e: DataFrame) -> DataFrame:
    """Pollution × degree per connected station (isolated stations are left out)."""
    return (
        v.join(degrees(e), "id")
        .select("id", "name", "city", "pollution", "degree", (F.col("pollution") * F.col("degree")).alias("score"))
    )


def critical_stations(v: DataFrame, e: DataFrame, *, k: int = 10) -> DataFrame:
    order = (F.col("score").desc(), F.col("id"))
    return _ranked(criticality(v, e).orderBy(*order).limit(k), *order)


# -- propagation -----------------------------------------------------------------


#: Hubs that may be sent to every task.
_MOST_HUBS = 100_000


def hub_parts(adj: DataFrame, *, hub_degree: int) -> DataFrame:
    """``hub, parts``: vertices with more than ``hub_degree`` directed edges, and into how many parts these are cut.

    With E directed edges the limit is never below E / 100,000, so there are
    never more hubs than that and the table may go to every task.
    """
    limit = max(hub_degree, -(-adj.count() // _MOST_HUBS))
    sizes = adj.groupBy("src").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    return sizes.select(F.col("src").alias("hub"), F.ceil(F.col("_n") / limit).cast("int").alias("parts"))


def cut_hubs(adj: DataFrame, hubs: DataFrame) -> DataFrame:
    """Directed edges with ``part``: a hub's edges are dealt over its parts by their other end, others have part 0."""
    known = adj.join(F.broadcast(hubs), adj.src == hubs.hub, "left")
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("dst"), F.col("parts"))).cast("int")
    return known.select("src", "dst", part.alias("part"))


def propagate(
    v: DataFrame,
    e: DataFrame,
    *,
    rounds: int = PROPAGATION_ROUNDS,
    factor: float = PROPAGATION_FACTOR,
    hub_degree: int = 100_000,
) -> DataFrame:
    """Spread pollution along edges: ``x += factor * sum(neighbour x)``, ``rounds`` times.

    Every round uses the values of the previous round; a vertex receives one
    message per incident edge (parallel edges twice); isolated vertices keep
    their value.  Equals ``(I + factor·A)^rounds · x0``.

    Vertices and edges are stored once.  The edges of a vertex with more than
    ``hub_degree`` of them are cut into parts (``cut_hubs``), each of which meets a copy
    of the vertex's value; messages to it are summed in the tasks they
    arise in, so no task gets all edges of a hub.

    Returns ``(id, name, city, initial, propagated, gain)``.
    """
    v = cut_lineage(v.select("id", "name", "city", "pollution"))
    adj = cut_lineage(both_directions(e))
    hubs = cut_lineage(hub_parts(adj, hub_degree=hub_degree))
    cut = not hubs.isEmpty()
    if cut:
        adj = cut_lineage(cut_hubs(adj, hubs))
    state = v.select("id", F.col("pollution").alias("x"))
    for _ in range(rounds):
        # Own value and incoming messages meet in one aggregation (one shuffle
        # on id, partial sums map-side), instead of an aggregate then a join.
        own = state.select("id", F.col("x").alias("own"), F.lit(None).cast("double").alias("m"))
        if cut:
            parts = F.sequence(F.lit(0), F.coalesce(F.col("parts") - 1, F.lit(0)))
            given = state.join(F.broadcast(hubs), state.id == hubs.hub, "left").select("id", "x", F.explode(parts).alias("_part"))
            met = adj.join(given, (adj.src == given.id) & (adj.part == given._part))
        else:
            met = adj.join(state, adj.src == state.id)
        msgs = met.select(adj.dst.alias("id"), F.lit(None).cast("double").alias("own"), F.col("x").alias("m"))
        nxt = (
            own.unionByName(msgs)
            .groupBy("id")
            .agg(F.max("own").alias("x"), F.sum("m").alias("m"))
            .select(
                "id",
                F.when(F.col("m").isNull(), F.col("x"))
                .otherwise(F.col("x") + F.col("m") * F.lit(factor))
                .alias("x"),
            )
        )
        state = cut_lineage(nxt)
    return v.join(state, "id").select(
        "id",
        "name",
        "city",
        F.col("pollution").alias("initial"),
        F.col("x").alias("propagated"),
        (F.col("x") - F.col("pollution")).alias("gain"),
    )


def top_propagation(v: DataFrame, e: DataFrame, *, k: int = 10, **kw) -> DataFrame:
    order = (F.col("gain").desc(), F.col("id"))
    return _ranked(propagate(v, e, **kw).orderBy(*order).limit(k), *order)


# -- connected components -----------------------------------------------------------


def components(v: DataFrame, e: DataFrame) -> DataFrame:
    """Connected components: ``(id, component)``, component = smallest id in it.

    Rounds of contraction: every vertex points to the smallest of itself and
    its neighbours, pointers are followed to their roots by doubling (rows that
    have arrived leave the work), and the edges between roots are the next
    round's graph, with at most half as many connected vertices.  The neighbour minimum is a partial aggregate, so a hub
    costs a row per task; both sides of every join come from checkpoints, so
    their exchanges are plain and a hub's rows can be split at run time.
    """
    pairs = e.select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
    pairs = cut_lineage(pairs.filter("a <> b").distinct())
    labels = v.select("id", F.col("id").alias("component"))
    while not pairs.isEmpty():
        ends = pairs.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p"))
        low = ends.groupBy(F.col("p.a").alias("x")).agg(F.min("p.b").alias("m"))
        root = _roots(low.select("x", F.least("x", "m").alias("to")))
        labels = labels.join(root.toDF("component", "_root"), "component", "left").select(
            "id", F.coalesce("_root", "component").alias("component")
        )
        joined = pairs.join(root.toDF("a", "_ra"), "a").join(root.toDF("b", "_rb"), "b").filter("_ra <> _rb")
        pairs = cut_lineage(joined.select(F.least("_ra", "_rb").alias("a"), F.greatest("_ra", "_rb").alias("b")).distinct())
    return labels


def _roots(point: DataFrame) -> DataFrame:
    """``x, to`` with ``to`` the end of x's pointer chain: two hops a step, rows at their end leave the work."""
    moving, settled = cut_lineage(point), []
    while True:
        table = moving
        for part in settled:
            table = table.unionByName(part)
        first = table.select(F.col("x").alias("_x1"), F.col("to").alias("_to1"))
        second = table.select(F.col("x").alias("_x2"), F.col("to").alias("_to2"))
        hop = moving.join(first, F.col("to") == F.col("_x1")).join(second, F.col("_to1") == F.col("_x2"))
        step = cut_lineage(hop.select("x", F.col("_to2").alias("to"), (F.col("_to1") == F.col("_to2")).alias("_end")))
        settled.append(step.filter("_end").select("x", "to"))
        moving = step.filter("not _end").select("x", "to")
        if moving.isEmpty():
            out = settled[0]
            for part in settled[1:]:
                out = out.unionByName(part)
            return out


def component_sizes(cc: DataFrame) -> DataFrame:
    return cc.groupBy("component").agg(F.count(F.lit(1)).alias("size"))


def largest_components(cc: DataFrame, *, k: int = 5) -> DataFrame:
    order = (F.col("size").desc(), F.col("component"))
    return _ranked(component_sizes(cc).orderBy(*order).limit(k), *order)


def component_count(cc: DataFrame) -> DataFrame:
    return cc.agg(F.countDistinct("component").alias("n_components"), F.count(F.lit(1)).alias("n_vertices"))


# -- per-city views and export -------------------------------------------------------


def city_nodes(v: DataFrame) -> DataFrame:
    """Node records of the per-city network: lines as sorted text."""
    return v.select(
        "id",
        "name",
        "city",
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        "pollution",
        lines_text("lines").alias("lines"),
    )


def city_edges(v: DataFrame, e: DataFrame) -> DataFrame:
    """Edges whose two ends are stations of the edge's city (all cities at once)."""
    ids = v.select(F.col("id").alias("_id"), F.col("city").alias("_city"))
    inside = (
        e.join(ids, (e.src == ids._id) & (e.city == ids._city), "left_semi")
        .join(ids, (F.col("dst") == ids._id) & (F.col("city") == ids._city), "left_semi")
    )
    return inside.select(F.col("src").alias("source"), F.col("dst").alias("target"), "line", "city")


def _filed(df: DataFrame, key: str, rows_per_file: int) -> DataFrame:
    """``df`` dealt into one task per file: a city with more than ``rows_per_file`` rows gets several."""
    sizes = cut_lineage(df.groupBy("city").agg(F.count(F.lit(1)).alias("_n")))
    files = F.ceil(F.col("_n") / rows_per_file).cast("int")
    total = sizes.agg(F.sum(files)).first()[0] or 1
    # Cities of more than one file: at most as many as there are files' worth of rows.
    large = sizes.filter(F.col("_n") > rows_per_file).select(F.col("city").alias("_city"), files.alias("_files"))
    part = F.pmod(F.xxhash64(key), F.coalesce("_files", F.lit(1))).cast("int")
    dealt = df.join(F.broadcast(large), F.col("city").eqNullSafe(F.col("_city")), "left").withColumn("_part", part)
    return dealt.repartition(int(total), "city", "_part").drop("_city", "_files", "_part")


def export_network(
    v: DataFrame, e: DataFrame, path: str, *, mode: str = "overwrite", rows_per_file: int = 1_000_000
) -> None:
    """Write nodes and edges as JSON records, one folder per city (no driver collect).

    The number of files follows from the rows alone: a city has a file per
    ``rows_per_file`` rows (about; never more than twice as many in one), however many partitions the input has.
    Vertices and edges are derived once for both sinks.
    """
    v, e = cut_lineage(v), cut_lineage(e)
    for name, rows, key in (("nodes", city_nodes(v), "id"), ("edges", city_edges(v, e), "source")):
        filed = _filed(cut_lineage(rows), key, rows_per_file)
        filed.write.mode(mode).option("maxRecordsPerFile", 2 * rows_per_file).partitionBy("city").json(f"{path}/{name}")


def city_summary(v: DataFrame, e: DataFrame) -> DataFrame:
    """Per city: stations, edges, mean and max pollution."""
    nodes = v.groupBy("city").agg(
        F.count(F.lit(1)).alias("n_nodes"),
        F.avg("pollution").alias("mean_pollution"),
        F.max("pollution").alias("max_pollution"),
    )
    links = city_edges(v, e).groupBy("city").agg(F.count(F.lit(1)).alias("n_edges"))
    return nodes.join(links, "city", "left").select(
        "city", "n_nodes", F.coalesce("n_edges", F.lit(0)).alias("n_edges"), "mean_pollution", "max_pollution"
    )


def upper_quartile_stations(v: DataFrame, *, q: float = 0.75) -> DataFrame:
    """Stations above their city's upper quartile (linear interpolation) of pollution; stations without a city are left out.

    The thresholds are selected by narrowing value ranges for all cities at
    once: a city with most of the stations is not gathered in one task.  A
    station without a pollution value, or in a city without any, has no mark (null).
    """
    v = cut_lineage(v.select("id", "name", "city", "pollution").filter("city is not null"))
    cut = exact_quantiles(v, "pollution", (q,), by=("city",), interpolate=True)
    return (
        v.join(cut.select("city", F.col("q0").alias("threshold")), "city", "left")
        .select("id", "name", "city", "pollution", "threshold")
        .withColumn("highlighted", F.col("pollution") > F.col("threshold"))
    )
