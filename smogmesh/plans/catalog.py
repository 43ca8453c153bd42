"""Registry of end-to-end queries over the test tables, and their SQL oracles.

Each query takes ``(spark, sf_dir)``, builds the readings view from the
``events`` and ``region`` tables of that folder and runs one analysis over the
whole view.  ``oracle_sql()`` gives, for the same key, a DuckDB statement that
computes the same rows independently; column names are identical.

Output doubles are rounded to 6 places (2 where the analysis itself rounds)
on both sides so that the comparison does not hinge on summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smogmesh.operators import anomalies as an
from smogmesh.operators import clean as cl
from smogmesh.operators import explore as ex
from smogmesh.operators import graph as gr
from smogmesh.operators import profiles as pr
from smogmesh.operators import regress as rg
from smogmesh.operators import stations as st
from smogmesh.plans import model_sql as ms
from smogmesh.schema import QUANTILE_ERROR, READING_COLUMNS, SENSOR_COLUMNS
from smogmesh.session import scratch_path
from smogmesh.sources.readings import line_report, load_readings, read_readings, readings_view, write_readings_csv
from smogmesh.streaming import feeds as sa

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6


def present(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column to ``digits`` places (presentation only)."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return readings_view(spark, d)


def _clean(spark: SparkSession, d: str) -> DataFrame:
    return cl.clean(readings_view(spark, d))


def _graph(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    # Edges take distinct stations anyway: complete rows suffice, without the dedupe of whole rows.
    raw = _raw(spark, d)
    return gr.vertices(cl.clean(raw)), gr.edges(cl.drop_missing(raw))


def _vertices_text(spark: SparkSession, d: str) -> DataFrame:
    v, _ = _graph(spark, d)
    return v.withColumn("lines", F.array_join("lines", ", "))


# --- queries needing a scratch folder (written through Spark, read back) ---------


def _readings_csv(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "readings-csv")
    write_readings_csv(_raw(spark, d), path)
    return load_readings(spark, path)


def _csv_report(spark: SparkSession, d: str) -> DataFrame:
    """Lines of which some lost their last field, got one more or hold a word for a number, read back and counted."""
    t = F.expr("timestamp div 1000 % 60")
    cells = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in READING_COLUMNS}
    cells["pm25"] = F.when(t == 2, "much").otherwise(cells["pm25"])
    short = F.concat_ws(",", *[cells[c] for c in READING_COLUMNS[:-1]])
    line = F.when(t == 0, short).when(t == 1, F.concat_ws(",", short, cells["rain"], F.lit("x"))).otherwise(F.concat_ws(",", short, cells["rain"]))
    path = scratch_path(spark, "readings-lines")
    _raw(spark, d).select(line.alias("value")).write.text(path)
    return line_report(read_readings(spark, path, header=False))


def _network_export(spark: SparkSession, d: str) -> DataFrame:
    v, e = _graph(spark, d)
    path = scratch_path(spark, "network")
    gr.export_network(v, e, path)
    schema = "id long, name string, lat double, lon double, pollution double, lines string, city string"
    return spark.read.schema(schema).json(f"{path}/nodes").select(
        "id", "name", "city", "lat", "lon", "pollution", "lines"
    )


def _network_export_edges(spark: SparkSession, d: str) -> DataFrame:
    v, e = _graph(spark, d)
    path = scratch_path(spark, "network")
    gr.export_network(v, e, path)
    schema = "source long, target long, line string, city string"
    return spark.read.schema(schema).json(f"{path}/edges").select("source", "target", "line", "city")


def _stream_append(spark: SparkSession, d: str) -> DataFrame:
    base = scratch_path(spark, "sensor-append")
    sa.write_sensor_files(_raw(spark, d), f"{base}/input")
    stream = sa.read_sensors(spark, f"{base}/input", glob="part-*.csv")
    q = sa.start_feed(
        sa.abnormal(stream), path=f"{base}/out", checkpoint=f"{base}/checkpoint", trigger={"availableNow": True}
    )
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select(*SENSOR_COLUMNS, "pollution_index", "severity")


def _stream_two_queries(spark: SparkSession, d: str) -> DataFrame:
    """Rows per feed and severity of the two independent queries."""
    base = scratch_path(spark, "sensor-two")
    sa.write_sensor_files(_raw(spark, d), f"{base}/input")
    stream = sa.read_sensors(spark, f"{base}/input", glob="part-*.csv")
    for q in sa.run_separate(stream, f"{base}/out", checkpoint=f"{base}/checkpoint", trigger={"availableNow": True}):
        q.awaitTermination()
    feeds = [sa.read_feed(spark, f"{base}/out", f).withColumn("feed", F.lit(f)) for f in ("abnormal", "alerts")]
    return feeds[0].unionByName(feeds[1]).groupBy("feed", "severity").agg(F.count(F.lit(1)).alias("rows"))


def _stream_feed(feed: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        base = scratch_path(spark, "sensor-stream")
        sa.write_sensor_files(_raw(spark, d), f"{base}/input")
        stream = sa.read_sensors(spark, f"{base}/input", glob="part-*.csv")
        q = sa.run_alerts(
            stream, f"{base}/out", checkpoint=f"{base}/checkpoint", trigger={"availableNow": True}
        )
        q.awaitTermination()
        return sa.read_feed(spark, f"{base}/out", feed).select(*SENSOR_COLUMNS, "pollution_index", "severity")

    return run


# --- ML (no SQL oracle: rows-only check) -----------------------------------------------


def _fitted(spark: SparkSession, d: str, names: tuple[str, ...] = rg.MODEL_NAMES) -> rg.Fitted:
    return rg.fit_models(_clean(spark, d), names=names)


def _model_metrics(spark, d):
    return rg.model_metrics(_fitted(spark, d))


def _best_model(spark, d):
    return rg.best_model(rg.model_metrics(_fitted(spark, d)))


def _feature_importance(spark, d):
    return rg.feature_importance(spark, _fitted(spark, d, ("random_forest",)))


def _predictions(spark, d):
    return rg.predictions(_fitted(spark, d, ("random_forest",)), "random_forest").select("label", "prediction")


def _trees_replayed(spark, d):
    """Per tree model: test rows, and those whose prediction comes out again from the exported leaves alone."""
    fitted = _fitted(spark, d, ("decision_tree", "random_forest"))
    out = None
    for name in ("decision_tree", "random_forest"):
        leaves = rg.tree_leaves(spark, fitted.models[name]).collect()  # bounded by the models' depth
        rows = rg.feature_rows(rg.predictions(fitted, name), "prediction")
        same = F.abs(F.col("prediction") - rg.replay_column(leaves)) < 1e-9
        counts = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(same).alias("n_same"))
        part = counts.select(F.lit(name).alias("model"), "n_rows", "n_same")
        out = part if out is None else out.unionByName(part)
    return out


def _category_codes(spark, d):
    return rg.category_codes(spark, rg.assembled(rg.prepare(_clean(spark, d)))[0])


def _feature_rows(spark, d):
    return rg.feature_rows(rg.assembled(rg.prepare(_clean(spark, d)))[1])


def _ridge_coefficients(spark, d):
    model, _ = rg.ridge(_clean(spark, d))
    return model.table(spark)


def _ridge_predictions(spark, d):
    model, rows = rg.ridge(_clean(spark, d))
    return model.predict(rows.filter("not is_train")).select("label", "prediction")


def _ridge_metrics(spark, d):
    return rg.metrics(_ridge_predictions(spark, d))


def _ridge_gradient(spark, d):
    model, _ = rg.ridge(_clean(spark, d))
    return spark.createDataFrame([(model.n, model.gradient)], "n_train long, gradient double")


_FIXED_COLS = ("station_name", "hour", "day_of_week", "anomalie_type", "pm25", "pm10", "no2", "o3", "co2", "temperature")
_Z_COLS = ("station_name", "hour", "anomalie_zscore", "pm25", "z_pm25", "pm10", "z_pm10", "co2", "z_co2", "no2", "z_no2")
_IQR_COLS = ("station_name", "hour", "day_of_week", "pm25", "pm10", "co2", "no2")
_CTX_COLS = ("station_name", "hour", "day_of_week", "anomalie_contexte", "pm25", "pm10", "co2", "temperature")


def _fixed_top(spark, d):
    rows = an.fixed_limits(_raw(spark, d)).select(*_FIXED_COLS)
    order = [F.col("pm25").desc()] + [F.col(c).asc_nulls_first() for c in _FIXED_COLS if c != "pm25"]
    return rows.orderBy(*order).limit(10)


def _zscore_top(spark, d):
    rows = an.zscore(_raw(spark, d)).select(*_Z_COLS)
    order = [F.col("z_pm25").desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in _Z_COLS if not c.startswith("z_")]
    return rows.orderBy(*order).limit(10)


def _iqr_top(spark, d):
    rows = an.iqr(_raw(spark, d)).select(*_IQR_COLS)
    order = [F.col("pm25").desc()] + [F.col(c).asc_nulls_first() for c in _IQR_COLS if c != "pm25"]
    return rows.orderBy(*order).limit(10)


def _context_top(spark, d):
    rows = an.context_anomalies(_raw(spark, d)).select(*_CTX_COLS)
    order = [F.col("pm25").desc_nulls_last()] + [F.col(c).asc_nulls_first() for c in _CTX_COLS if c != "pm25"]
    return rows.orderBy(*order).limit(10)


def _quartiles_approximate(spark, d):
    """Whether each approximate quartile of wind speed keeps the stated rank error, by exact counts."""
    found = an.quartile_rank_errors(_raw(spark, d), "wind_speed")
    return found.select("prob", "n", (F.col("rank_error") <= QUANTILE_ERROR).alias("within_error"))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        # cleaning and quality
        "clean_readings": lambda s, d: _clean(s, d),
        "quality_profile": lambda s, d: cl.quality_profile(_raw(s, d)),
        "network_inventory": lambda s, d: cl.network_inventory(_raw(s, d)),
        "readings_csv": _readings_csv,
        "csv_line_report": _csv_report,
        # scalar columns
        "who_index": lambda s, d: pr.with_who_index(_raw(s, d)).select("station_id", "timestamp", "pollution_index"),
        "weighted_index": lambda s, d: pr.weighted_readings(_clean(s, d)),
        "time_parts": lambda s, d: pr.with_time_parts(_clean(s, d)),
        "name_tokens": lambda s, d: pr.name_tokens(_clean(s, d)),
        "high_readings": lambda s, d: pr.high_readings(_clean(s, d)),
        "service_periods": lambda s, d: pr.service_periods(_raw(s, d)),
        # statistics and profiles
        "station_pm25": lambda s, d: pr.station_pm25(_clean(s, d)),
        "line_co2": lambda s, d: pr.line_co2(_clean(s, d)),
        "hourly_profile": lambda s, d: pr.hourly_profile(_raw(s, d)),
        "weekday_profile": lambda s, d: pr.weekday_profile(_raw(s, d)),
        "critical_periods": lambda s, d: pr.critical_periods(_raw(s, d)),
        "peak_hours": lambda s, d: pr.peak_hours(_raw(s, d)),
        "calm_hours": lambda s, d: pr.peak_hours(_raw(s, d), calm=True),
        "station_stats": lambda s, d: st.station_stats(_raw(s, d)),
        "station_ranking": lambda s, d: st.station_ranking(_raw(s, d)),
        "station_peaks": lambda s, d: st.station_peaks(_raw(s, d)),
        "station_peaks_max": lambda s, d: st.station_peaks(_raw(s, d), order_by="max"),
        "network_total": lambda s, d: st.network_total(_raw(s, d)),
        # anomalies
        "anomalies_fixed": lambda s, d: an.fixed_limits(_raw(s, d)).select(*_FIXED_COLS),
        "anomalies_fixed_top": _fixed_top,
        "anomalies_fixed_by_type": lambda s, d: an.count_by(an.fixed_limits(_raw(s, d)), "anomalie_type"),
        "global_stats": lambda s, d: an.global_stats(_raw(s, d)),
        "anomalies_zscore": lambda s, d: an.zscore(_raw(s, d)).select(*_Z_COLS),
        "anomalies_zscore_top": _zscore_top,
        "anomalies_iqr_top": _iqr_top,
        "quartile_fences": lambda s, d: an.quartile_fences(_raw(s, d)),
        "quartile_fences_wind": lambda s, d: an.quartile_fences(_raw(s, d), "wind_speed"),
        "quartiles_approximate": _quartiles_approximate,
        "anomalies_iqr": lambda s, d: an.iqr(_raw(s, d)).select(*_IQR_COLS),
        "anomalies_context": lambda s, d: an.context_anomalies(_raw(s, d)).select(*_CTX_COLS),
        "anomalies_context_top": _context_top,
        "anomalies_context_by_type": lambda s, d: an.count_by(an.context_anomalies(_raw(s, d)), "anomalie_contexte"),
        "anomaly_summary": lambda s, d: an.summary(_raw(s, d)),
        # graph
        "graph_vertices": _vertices_text,
        "graph_edges": lambda s, d: gr.edges(_clean(s, d)),
        "graph_counts": lambda s, d: gr.graph_counts(*_graph(s, d)),
        "degrees": lambda s, d: gr.degrees(_graph(s, d)[1]),
        "top_vertices": lambda s, d: gr.top_vertices(_graph(s, d)[0]),
        "critical_stations": lambda s, d: gr.critical_stations(*_graph(s, d)),
        "propagation": lambda s, d: gr.propagate(*_graph(s, d)),
        "top_propagation": lambda s, d: gr.top_propagation(*_graph(s, d)),
        "components": lambda s, d: gr.components(*_graph(s, d)),
        "component_sizes": lambda s, d: gr.component_sizes(gr.components(*_graph(s, d))),
        "largest_components": lambda s, d: gr.largest_components(gr.components(*_graph(s, d))),
        "component_count": lambda s, d: gr.component_count(gr.components(*_graph(s, d))),
        "city_nodes": lambda s, d: gr.city_nodes(_graph(s, d)[0]),
        "city_edges": lambda s, d: gr.city_edges(*_graph(s, d)),
        "network_export": _network_export,
        "network_export_edges": _network_export_edges,
        "city_summary": lambda s, d: gr.city_summary(*_graph(s, d)),
        "upper_quartile_stations": lambda s, d: gr.upper_quartile_stations(_graph(s, d)[0]),
        # exploration
        "correlations": lambda s, d: ex.correlations(_clean(s, d)),
        "pm25_describe": lambda s, d: ex.describe_column(_clean(s, d), "pm25"),
        "pm25_frequency": lambda s, d: ex.top_values(_clean(s, d), "pm25"),
        # streaming
        "stream_abnormal": _stream_feed("abnormal"),
        "stream_alerts": _stream_feed("alerts"),
        "stream_append": _stream_append,
        "stream_two_queries": _stream_two_queries,
        # models (rows-only check)
        "model_metrics": _model_metrics,
        "best_model": _best_model,
        "feature_importance": _feature_importance,
        "predictions": _predictions,
        "model_split_sizes": lambda s, d: rg.split_sizes(_clean(s, d)),
        "trees_replayed": _trees_replayed,
        "category_codes": _category_codes,
        "feature_rows": _feature_rows,
        "ridge_coefficients": _ridge_coefficients,
        "ridge_predictions": _ridge_predictions,
        "ridge_metrics": _ridge_metrics,
        "ridge_gradient": _ridge_gradient,
    }
    return {k: _presented(fn) for k, fn in q.items()}


def _presented(fn: Query) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return present(fn(spark, d))

    run.__name__ = getattr(fn, "__name__", "query")
    return run


# =====================================================================================
# Oracles (DuckDB SQL over the same parquet tables)
# =====================================================================================


def _dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _index_sql(nulls: str = "null", prefix: str = "") -> str:
    parts = []
    for name, limit, weight in (
        ("pm25", 25.0, 3.0),
        ("pm10", 50.0, 2.0),
        ("co2", 1000.0, 0.5),
        ("no2", 40.0, 2.0),
        ("o3", 100.0, 1.0),
    ):
        col = f"{prefix}{name}"
        if nulls == "zero":
            col = f"coalesce({col}, 0)"
        parts.append(f"({_dbl(col)} / {_dbl(limit)}) * {_dbl(weight)}")
    return "((" + " + ".join(parts) + f") / {_dbl(8.5)})"


def _r(x: str, digits: int = DIGITS) -> str:
    return f"round({x}, {digits})"


_LINE_NO = "CAST((e.user_id // 10) % 2 AS VARCHAR)"
_K = "CAST(json_extract(e.props, '$.k') AS INTEGER)"

READINGS_CTE = f"""
ev AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value, r.r_name,
         {_K} AS k, hour(e.ts) AS h, {_LINE_NO} AS line_no
  FROM events e JOIN region r ON r.r_regionkey = e.user_id % 5
),
base AS (
  SELECT
    event_id,
    CAST(user_id AS INTEGER) AS station_id,
    r_name || '-L' || line_no || '-S' || CAST(user_id AS VARCHAR) AS station_name,
    r_name AS city,
    CAST(40.0 AS DOUBLE) + CAST(user_id % 5 AS DOUBLE) * CAST(1.0 AS DOUBLE)
      + CAST(user_id % 13 AS DOUBLE) * CAST(0.01 AS DOUBLE) AS latitude,
    CAST(2.0 AS DOUBLE) + CAST(user_id % 5 AS DOUBLE) * CAST(1.0 AS DOUBLE)
      + CAST(user_id % 11 AS DOUBLE) * CAST(0.01 AS DOUBLE) AS longitude,
    CASE WHEN user_id % 7 = 0 AND user_id % 5 < 2 AND event_type = 'error' THEN 'LX'
         ELSE 'L' || line_no END AS line,
    CAST(epoch_us(ts) // 1000 AS BIGINT) AS timestamp,
    CAST(h AS INTEGER) AS hour,
    CAST(isodow(ts) AS INTEGER) AS day_of_week,
    CAST(month(ts) AS INTEGER) AS month,
    CAST(CASE WHEN event_id % 50 = 7 THEN NULL
              WHEN h BETWEEN 1 AND 4 AND event_id % 10 <> 3 THEN 0
              WHEN event_id % 211 = 0 THEN 0
              ELSE floor(value * CAST(0.8 AS DOUBLE)) END AS INTEGER) AS pm25,
    CAST(CASE WHEN event_id % 50 = 11 THEN NULL
              ELSE floor(value * CAST(0.7 AS DOUBLE)) + k % 40 END AS INTEGER) AS pm10,
    CAST(CASE WHEN event_id % 50 = 13 THEN NULL ELSE 400 + k * 8 + floor(value) END AS INTEGER) AS co2,
    CAST(CASE WHEN event_id % 50 = 17 THEN NULL
              ELSE floor(value * CAST(0.3 AS DOUBLE)) + k % 30 END AS INTEGER) AS no2,
    CAST(CASE WHEN event_id % 97 = 0 THEN 210 ELSE k % 60 END AS INTEGER) AS o3,
    CAST(30 + (k * 7) % 55 AS INTEGER) AS noise,
    CAST(CASE WHEN event_id % 50 = 19 THEN NULL ELSE 40 + k % 60 END AS INTEGER) AS humidity,
    CAST(CASE WHEN event_id % 50 = 23 THEN NULL
              WHEN event_id % 99 = 0 THEN 60
              WHEN event_id % 101 = 0 THEN -15
              ELSE 5 + k % 30 END AS INTEGER) AS temperature,
    CASE WHEN event_id % 50 = 29 THEN NULL ELSE value / CAST(50.0 AS DOUBLE) END AS wind_speed,
    CAST(CASE WHEN 40 + k % 60 > 70 AND event_id % 5 < 2 THEN 1 ELSE 0 END AS INTEGER) AS rain
  FROM ev
),
readings AS (
  SELECT {", ".join(READING_COLUMNS)} FROM base
  UNION ALL
  SELECT {", ".join(READING_COLUMNS)} FROM base WHERE event_id % 100 = 1
),
clean AS (
  SELECT DISTINCT * FROM readings
  WHERE {" AND ".join(f"{c} IS NOT NULL" for c in READING_COLUMNS)}
),
raw_i AS (SELECT *, {_index_sql()} AS pollution_index FROM readings),
raw_z AS (SELECT *, {_index_sql("zero")} AS idx0 FROM readings),
clean_z AS (SELECT *, {_index_sql("zero")} AS idx0 FROM clean)"""

GRAPH_CTE = """,
per_key AS (
  SELECT station_id, station_name, city, latitude, longitude, avg(idx0) AS pollution,
         list_sort(list_distinct(list(line))) AS lines
  FROM clean_z GROUP BY station_id, station_name, city, latitude, longitude
),
vertices AS (
  SELECT CAST(station_id AS BIGINT) AS id, station_name AS name, city, latitude, longitude, pollution, lines
  FROM (SELECT *, row_number() OVER (PARTITION BY station_id
                                     ORDER BY station_name, city, latitude, longitude) AS rn FROM per_key)
  WHERE rn = 1
),
stations AS (SELECT DISTINCT line, station_id, city FROM clean),
edges AS (
  SELECT src, dst, line, city FROM (
    SELECT CAST(station_id AS BIGINT) AS src,
           CAST(lead(station_id) OVER (PARTITION BY line, city ORDER BY station_id) AS BIGINT) AS dst,
           line, city
    FROM stations) WHERE dst IS NOT NULL
),
both_dirs AS (SELECT src, dst FROM edges UNION ALL SELECT dst AS src, src AS dst FROM edges),
degrees AS (SELECT src AS id, count(*) AS degree FROM both_dirs GROUP BY src)"""

CC_CTE = """,
cc(id, comp) USING KEY (id) AS (
  SELECT id, id FROM vertices
  UNION
  SELECT b.dst, min(r.comp)
  FROM recurring.cc r JOIN both_dirs b ON r.id = b.src JOIN recurring.cc s ON s.id = b.dst
  GROUP BY b.dst, s.comp
  HAVING min(r.comp) < s.comp
)"""


def _prop_cte(rounds: int = 5, factor: float = 0.1) -> str:
    out = [",\nx0 AS (SELECT id, pollution AS x FROM vertices)"]
    for i in range(1, rounds + 1):
        out.append(
            f",\nm{i} AS (SELECT b.dst AS id, sum(x.x) AS m FROM both_dirs b JOIN x{i-1} x ON x.id = b.src GROUP BY b.dst)"
            f",\nx{i} AS (SELECT x.id, CASE WHEN m.m IS NULL THEN x.x ELSE x.x + m.m * {_dbl(factor)} END AS x "
            f"FROM x{i-1} x LEFT JOIN m{i} m ON m.id = x.id)"
        )
    out.append(
        f""",
prop AS (
  SELECT v.id, v.name, v.city, v.pollution AS initial, x.x AS propagated, x.x - v.pollution AS gain
  FROM vertices v JOIN x{rounds} x ON x.id = v.id
)"""
    )
    return "".join(out)


def _with(body: str, *extra: str) -> str:
    return "WITH RECURSIVE" + READINGS_CTE + "".join(extra) + "\n" + body


_FIXED_CASE = """CASE WHEN pm25 > 75.0 THEN 'PM2.5_CRITIQUE'
     WHEN pm10 > 150.0 THEN 'PM10_CRITIQUE'
     WHEN no2 > 100.0 THEN 'NO2_CRITIQUE'
     WHEN o3 > 200.0 THEN 'O3_CRITIQUE'
     WHEN co2 > 1500.0 THEN 'CO2_CRITIQUE'
     WHEN temperature < 0.0 OR temperature > 45.0 THEN 'TEMP_IMPOSSIBLE'
     ELSE 'NORMAL' END"""

_CTX_CASE = """CASE WHEN (hour BETWEEN 7 AND 9 OR hour BETWEEN 17 AND 20) AND pm25 = 0 THEN 'POLLUTION_NULLE_POINTE'
     WHEN hour BETWEEN 1 AND 5 AND pm25 > 30.0 THEN 'POLLUTION_ELEVEE_NUIT'
     WHEN temperature < -10.0 OR temperature > 50.0 THEN 'TEMP_EXTREME' END"""

_STATS = """stats AS (
  SELECT avg(pm25) AS mean_pm25, stddev_samp(pm25) AS std_pm25,
         avg(pm10) AS mean_pm10, stddev_samp(pm10) AS std_pm10,
         avg(co2) AS mean_co2, stddev_samp(co2) AS std_co2,
         avg(no2) AS mean_no2, stddev_samp(no2) AS std_no2
  FROM readings
)"""

_ZROWS = f""",
{_STATS},
zr AS (
  SELECT r.*,
    abs((pm25 - mean_pm25) / nullif(std_pm25, 0)) AS z_pm25,
    abs((pm10 - mean_pm10) / nullif(std_pm10, 0)) AS z_pm10,
    abs((co2 - mean_co2) / nullif(std_co2, 0)) AS z_co2,
    abs((no2 - mean_no2) / nullif(std_no2, 0)) AS z_no2
  FROM readings r, stats
),
zanom AS (
  SELECT *, CASE WHEN z_pm25 > 3.0 THEN 'PM2.5_OUTLIER' WHEN z_pm10 > 3.0 THEN 'PM10_OUTLIER'
                 WHEN z_co2 > 3.0 THEN 'CO2_OUTLIER' WHEN z_no2 > 3.0 THEN 'NO2_OUTLIER'
                 ELSE 'NORMAL' END AS anomalie_zscore
  FROM zr WHERE z_pm25 > 3.0 OR z_pm10 > 3.0 OR z_co2 > 3.0 OR z_no2 > 3.0
)"""

_FENCES = """,
fences AS (
  SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
  FROM (SELECT CAST(percentile_disc(0.25) WITHIN GROUP (ORDER BY pm25) AS DOUBLE) AS q1,
               CAST(percentile_disc(0.75) WITHIN GROUP (ORDER BY pm25) AS DOUBLE) AS q3
        FROM readings)
)"""


def _profile_cols(digits: int = 2) -> str:
    return f"""round(avg(pollution_index), {digits}) AS pollution_moyenne,
  round(avg(pm25), {digits}) AS pm25_moyen, round(avg(pm10), {digits}) AS pm10_moyen,
  round(avg(co2), {digits}) AS co2_moyen, round(avg(no2), {digits}) AS no2_moyen,
  round(avg(noise), {digits}) AS bruit_moyen, count(*) AS nb_mesures"""


_WEEKDAY = """CASE day_of_week WHEN 1 THEN 'Lundi' WHEN 2 THEN 'Mardi' WHEN 3 THEN 'Mercredi'
  WHEN 4 THEN 'Jeudi' WHEN 5 THEN 'Vendredi' WHEN 6 THEN 'Samedi' WHEN 7 THEN 'Dimanche' END"""

_STATION_STATS = """station_stats AS (
  SELECT station_id, station_name, city, line, avg(idx0) AS mean_index, min(idx0) AS min_index,
         max(idx0) AS max_index, count(*) AS n_readings
  FROM raw_z GROUP BY station_id, station_name, city, line
)"""

_SEVERITY = """CASE WHEN pollution_index > 1.0 THEN 'DANGER' WHEN pollution_index > 0.5 THEN 'ELEVEE'
     ELSE 'NORMALE' END"""

_SENSOR = ", ".join(SENSOR_COLUMNS)


def oracle_sql() -> dict[str, str]:
    r = _r
    fixed_cols = ", ".join(_FIXED_COLS)
    rows = {
        "clean_readings": _with("SELECT * REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, round(wind_speed, 6) AS wind_speed) FROM clean"),
        "quality_profile": _with(
            f"""SELECT sum(n) AS rows, sum(n - 1) AS duplicate_rows, count(*) AS distinct_rows,
  count(*) FILTER (WHERE {" AND ".join(f"{c} IS NOT NULL" for c in READING_COLUMNS)}) AS rows_kept,
  {", ".join(f"coalesce(sum(n) FILTER (WHERE {c} IS NULL), 0) AS null_{c}" for c in READING_COLUMNS)}
FROM (SELECT {", ".join(READING_COLUMNS)}, count(*) AS n FROM readings GROUP BY ALL)"""
        ),
        "network_inventory": _with(
            """SELECT city, count(DISTINCT line) AS n_lines, count(DISTINCT station_id) AS n_stations,
  count(*) AS n_readings, grouping(city) = 1 AS is_total FROM readings GROUP BY ROLLUP (city)"""
        ),
        "readings_csv": _with("SELECT * REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, round(wind_speed, 6) AS wind_speed) FROM readings"),
        "csv_line_report": _with(
            """SELECT CASE timestamp // 1000 % 60 WHEN 0 THEN 'short' WHEN 1 THEN 'long' WHEN 2 THEN 'value' END AS reason,
  count(*) AS rows, count(station_id) AS with_station FROM readings GROUP BY reason"""
        ),
        "who_index": _with(f"SELECT station_id, timestamp, {r('pollution_index')} AS pollution_index FROM raw_i"),
        "weighted_index": _with(
            f"""SELECT station_name,
  {r(f"{_dbl('pm25')} * {_dbl(0.5)} + {_dbl('pm10')} * {_dbl(0.3)} + {_dbl('co2')} * {_dbl(0.2)}")} AS pollution_index
FROM clean"""
        ),
        "time_parts": _with(
            """SELECT timestamp, strftime(dt, '%Y-%m-%d %H:%M:%S') AS datetime, year(dt) AS year,
  month(dt) AS month_extracted, day(dt) AS day_extracted, hour(dt) AS hour_extracted
FROM (SELECT timestamp, make_timestamp((timestamp // 1000) * 1000000) AS dt FROM clean)"""
        ),
        "name_tokens": _with("SELECT unnest(string_split(station_name, '-')) AS token FROM clean"),
        "high_readings": _with("SELECT * REPLACE (round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, round(wind_speed, 6) AS wind_speed) FROM clean WHERE pm25 > 70"),
        "service_periods": _with(
            """SELECT CASE WHEN hour BETWEEN 7 AND 9 OR hour BETWEEN 17 AND 20 THEN 'rush'
            WHEN hour >= 1 AND hour < 5 THEN 'stopped'
            WHEN hour IS NOT NULL THEN 'normal' END AS period, count(*) AS count
FROM readings GROUP BY period"""
        ),
        "station_pm25": _with(
            f"""SELECT station_id, station_name, {r('avg(pm25)')} AS pm25_avg, max(pm25) AS pm25_max,
  min(pm25) AS pm25_min FROM clean GROUP BY station_id, station_name"""
        ),
        "line_co2": _with(
            f"""SELECT line, {r('avg(co2)')} AS co2_avg, max(co2) AS co2_max, min(co2) AS co2_min
FROM clean GROUP BY line"""
        ),
        "hourly_profile": _with(f"SELECT hour, {_profile_cols()} FROM raw_i GROUP BY hour"),
        "weekday_profile": _with(
            f"""SELECT coalesce({_WEEKDAY}, 'Inconnu') AS jour, pollution_moyenne, pm25_moyen, pm10_moyen,
  co2_moyen, bruit_moyen, nb_mesures
FROM (SELECT day_of_week, {_profile_cols()} FROM raw_i GROUP BY day_of_week)"""
        ),
        "critical_periods": _with(
            f"""SELECT ({_WEEKDAY}) || ' - ' || CAST(hour AS VARCHAR) || 'h' AS periode, pollution_moyenne, nb_mesures
FROM (SELECT day_of_week, hour, round(avg(pollution_index), 2) AS pollution_moyenne, count(*) AS nb_mesures
      FROM raw_i GROUP BY day_of_week, hour)
ORDER BY pollution_moyenne DESC NULLS LAST, day_of_week, hour LIMIT 20"""
        ),
        "peak_hours": _with(
            f"""SELECT hour, {_profile_cols()} FROM raw_i GROUP BY hour
ORDER BY pollution_moyenne DESC NULLS LAST, hour LIMIT 5"""
        ),
        "calm_hours": _with(
            f"""SELECT hour, {_profile_cols()} FROM raw_i GROUP BY hour
ORDER BY pollution_moyenne ASC NULLS FIRST, hour LIMIT 5"""
        ),
        "station_stats": _with(
            f"""SELECT station_id, station_name, city, line, {r('mean_index')} AS mean_index,
  {r('min_index')} AS min_index, {r('max_index')} AS max_index, n_readings FROM station_stats""",
            ",\n" + _STATION_STATS,
        ),
        "station_ranking": _with(
            f"""SELECT station_id, station_name, city, line, {r('mean_index')} AS mean_index,
  {r('min_index')} AS min_index, {r('max_index')} AS max_index, n_readings FROM station_stats
ORDER BY station_stats.mean_index DESC, station_id, station_name, city, line LIMIT 10""",
            ",\n" + _STATION_STATS,
        ),
        "station_peaks": _with(
            f"""SELECT station_id, station_name, city, line, {r('mean_index')} AS mean_index,
  {r('min_index')} AS min_index, {r('max_index')} AS max_index, n_readings FROM station_stats
WHERE station_stats.max_index > 2.0
ORDER BY station_stats.mean_index DESC, station_id, station_name, city, line LIMIT 10""",
            ",\n" + _STATION_STATS,
        ),
        "station_peaks_max": _with(
            f"""SELECT station_id, station_name, city, line, {r('mean_index')} AS mean_index,
  {r('min_index')} AS min_index, {r('max_index')} AS max_index, n_readings FROM station_stats
WHERE station_stats.max_index > 2.0
ORDER BY station_stats.max_index DESC, station_id, station_name, city, line LIMIT 10""",
            ",\n" + _STATION_STATS,
        ),
        "network_total": _with(
            f"""SELECT {r('sum(idx0)')} AS total, count(*) AS n_readings, {r('avg(idx0)')} AS mean_index,
  {r('coalesce(sum(idx0), 0.0)')} AS total_fold FROM raw_z"""
        ),
        "anomalies_fixed": _with(
            f"SELECT {fixed_cols} FROM (SELECT *, {_FIXED_CASE} AS anomalie_type FROM readings) WHERE anomalie_type <> 'NORMAL'"
        ),
        "anomalies_fixed_top": _with(
            f"""SELECT {fixed_cols} FROM (SELECT *, {_FIXED_CASE} AS anomalie_type FROM readings)
WHERE anomalie_type <> 'NORMAL'
ORDER BY pm25 DESC NULLS LAST, {", ".join(f"{c} ASC NULLS FIRST" for c in _FIXED_COLS if c != "pm25")} LIMIT 10"""
        ),
        "anomalies_fixed_by_type": _with(
            f"""SELECT anomalie_type, count(*) AS count FROM (SELECT {_FIXED_CASE} AS anomalie_type FROM readings)
WHERE anomalie_type <> 'NORMAL' GROUP BY anomalie_type"""
        ),
        "global_stats": _with(
            "SELECT "
            + ", ".join(f"{r(f'mean_{c}')} AS mean_{c}, {r(f'std_{c}')} AS std_{c}" for c in ("pm25", "pm10", "co2", "no2"))
            + " FROM stats",
            ",\n" + _STATS,
        ),
        "anomalies_zscore": _with(
            f"""SELECT station_name, hour, anomalie_zscore, pm25, {r('z_pm25')} AS z_pm25, pm10, {r('z_pm10')} AS z_pm10,
  co2, {r('z_co2')} AS z_co2, no2, {r('z_no2')} AS z_no2 FROM zanom""",
            _ZROWS,
        ),
        "anomalies_zscore_top": _with(
            f"""SELECT station_name, hour, anomalie_zscore, pm25, {r('z_pm25')} AS z_pm25, pm10, {r('z_pm10')} AS z_pm10,
  co2, {r('z_co2')} AS z_co2, no2, {r('z_no2')} AS z_no2 FROM zanom
ORDER BY zanom.z_pm25 DESC NULLS LAST, {", ".join(f"{c} ASC NULLS FIRST" for c in _Z_COLS if not c.startswith("z_"))} LIMIT 10""",
            _ZROWS,
        ),
        "anomalies_iqr_top": _with(
            f"""SELECT {", ".join(_IQR_COLS)} FROM readings, fences
WHERE pm25 < fences.lower OR pm25 > fences.upper
ORDER BY pm25 DESC, {", ".join(f"{c} ASC NULLS FIRST" for c in _IQR_COLS if c != "pm25")} LIMIT 10""",
            _FENCES,
        ),
        "quartile_fences": _with("SELECT q1, q3, iqr, lower, upper FROM fences", _FENCES),
        "quartile_fences_wind": _with(
            f"""SELECT {r('q1')} AS q1, {r('q3')} AS q3, {r('q3 - q1')} AS iqr, {r('q1 - 1.5 * (q3 - q1)')} AS lower,
  {r('q3 + 1.5 * (q3 - q1)')} AS upper
FROM (SELECT percentile_disc(0.25) WITHIN GROUP (ORDER BY wind_speed) AS q1,
             percentile_disc(0.75) WITHIN GROUP (ORDER BY wind_speed) AS q3 FROM readings)"""
        ),
        "quartiles_approximate": _with(
            f"""SELECT p.prob, n.n, true AS within_error FROM (VALUES ({_dbl(0.25)}), ({_dbl(0.5)}), ({_dbl(0.75)})) p(prob),
  (SELECT count(wind_speed) AS n FROM readings) n"""
        ),
        "anomalies_iqr": _with(
            f"""SELECT {", ".join(_IQR_COLS)} FROM readings, fences
WHERE pm25 < fences.lower OR pm25 > fences.upper""",
            _FENCES,
        ),
        "anomalies_context": _with(
            f"""SELECT {", ".join(_CTX_COLS)} FROM (SELECT *, {_CTX_CASE} AS anomalie_contexte FROM readings)
WHERE anomalie_contexte IS NOT NULL"""
        ),
        "anomalies_context_top": _with(
            f"""SELECT {", ".join(_CTX_COLS)} FROM (SELECT *, {_CTX_CASE} AS anomalie_contexte FROM readings)
WHERE anomalie_contexte IS NOT NULL
ORDER BY pm25 DESC NULLS LAST, {", ".join(f"{c} ASC NULLS FIRST" for c in _CTX_COLS if c != "pm25")} LIMIT 10"""
        ),
        "anomalies_context_by_type": _with(
            f"""SELECT anomalie_contexte, count(*) AS count FROM (SELECT {_CTX_CASE} AS anomalie_contexte FROM readings)
WHERE anomalie_contexte IS NOT NULL GROUP BY anomalie_contexte"""
        ),
        "anomaly_summary": _with(
            f"""SELECT method, anomalies, total, {r('anomalies * 100.0 / total')} AS share_pct FROM (
  SELECT count(*) AS total,
    count(*) FILTER (WHERE ({_FIXED_CASE}) <> 'NORMAL') AS fixed_limits,
    count(*) FILTER (WHERE z_pm25 > 3.0 OR z_pm10 > 3.0 OR z_co2 > 3.0 OR z_no2 > 3.0) AS zscore,
    count(*) FILTER (WHERE pm25 < fences.lower OR pm25 > fences.upper) AS iqr,
    count(*) FILTER (WHERE ({_CTX_CASE}) IS NOT NULL) AS context
  FROM zr, fences
) UNPIVOT (anomalies FOR method IN (fixed_limits, zscore, iqr, context))""",
            _ZROWS,
            _FENCES,
        ),
        # graph
        "graph_vertices": _with(
            f"""SELECT id, name, city, {r('latitude')} AS latitude, {r('longitude')} AS longitude, {r('pollution')} AS pollution,
  array_to_string(lines, ', ') AS lines FROM vertices""",
            GRAPH_CTE,
        ),
        "graph_edges": _with("SELECT src, dst, line, city FROM edges", GRAPH_CTE),
        "graph_counts": _with(
            "SELECT (SELECT count(*) FROM vertices) AS n_vertices, (SELECT count(*) FROM edges) AS n_edges", GRAPH_CTE
        ),
        "degrees": _with("SELECT id, degree FROM degrees", GRAPH_CTE),
        "top_vertices": _with(
            f"""SELECT id, name, city, {r('pollution')} AS pollution,
  row_number() OVER (ORDER BY pollution DESC, id) AS rank
FROM vertices ORDER BY vertices.pollution DESC, id LIMIT 10""",
            GRAPH_CTE,
        ),
        "critical_stations": _with(
            f"""SELECT id, name, city, {r('pollution')} AS pollution, degree, {r('score')} AS score,
  row_number() OVER (ORDER BY score DESC, id) AS rank
FROM (SELECT v.id, v.name, v.city, v.pollution, d.degree, v.pollution * d.degree AS score
      FROM vertices v JOIN degrees d ON d.id = v.id)
ORDER BY score DESC, id LIMIT 10""",
            GRAPH_CTE,
        ),
        "propagation": _with(
            f"""SELECT id, name, city, {r('initial')} AS initial, {r('propagated')} AS propagated,
  {r('gain')} AS gain FROM prop""",
            GRAPH_CTE,
            _prop_cte(),
        ),
        "top_propagation": _with(
            f"""SELECT id, name, city, {r('initial')} AS initial, {r('propagated')} AS propagated,
  {r('gain')} AS gain, row_number() OVER (ORDER BY gain DESC, id) AS rank
FROM prop ORDER BY prop.gain DESC, id LIMIT 10""",
            GRAPH_CTE,
            _prop_cte(),
        ),
        "components": _with("SELECT id, comp AS component FROM cc", GRAPH_CTE, CC_CTE),
        "component_sizes": _with("SELECT comp AS component, count(*) AS size FROM cc GROUP BY comp", GRAPH_CTE, CC_CTE),
        "largest_components": _with(
            """SELECT component, size, row_number() OVER (ORDER BY size DESC, component) AS rank
FROM (SELECT comp AS component, count(*) AS size FROM cc GROUP BY comp)
ORDER BY size DESC, component LIMIT 5""",
            GRAPH_CTE,
            CC_CTE,
        ),
        "component_count": _with(
            "SELECT count(DISTINCT comp) AS n_components, count(*) AS n_vertices FROM cc", GRAPH_CTE, CC_CTE
        ),
        "city_nodes": _with(
            f"""SELECT id, name, city, {r('latitude')} AS lat, {r('longitude')} AS lon, {r('pollution')} AS pollution,
  array_to_string(lines, ', ') AS lines FROM vertices""",
            GRAPH_CTE,
        ),
        "city_edges": _with(
            """SELECT e.src AS source, e.dst AS target, e.line, e.city FROM edges e
WHERE EXISTS (SELECT 1 FROM vertices a WHERE a.id = e.src AND a.city = e.city)
  AND EXISTS (SELECT 1 FROM vertices b WHERE b.id = e.dst AND b.city = e.city)""",
            GRAPH_CTE,
        ),
        "city_summary": _with(
            f"""SELECT n.city, n.n_nodes, coalesce(l.n_edges, 0) AS n_edges, {r('n.mean_pollution')} AS mean_pollution,
  {r('n.max_pollution')} AS max_pollution
FROM (SELECT city, count(*) AS n_nodes, avg(pollution) AS mean_pollution, max(pollution) AS max_pollution
      FROM vertices GROUP BY city) n
LEFT JOIN (SELECT e.city, count(*) AS n_edges FROM edges e
           WHERE EXISTS (SELECT 1 FROM vertices a WHERE a.id = e.src AND a.city = e.city)
             AND EXISTS (SELECT 1 FROM vertices b WHERE b.id = e.dst AND b.city = e.city)
           GROUP BY e.city) l ON l.city = n.city""",
            GRAPH_CTE,
        ),
        "upper_quartile_stations": _with(
            f"""SELECT v.id, v.name, v.city, {r('v.pollution')} AS pollution, {r('c.threshold')} AS threshold,
  v.pollution > c.threshold AS highlighted
FROM vertices v JOIN (SELECT city, quantile_cont(pollution, 0.75) AS threshold FROM vertices GROUP BY city) c
  ON c.city = v.city""",
            GRAPH_CTE,
        ),
        # exploration
        "correlations": _with(
            "SELECT "
            + ", ".join(
                f"{r(f'covar_pop(pm25, {c}) / nullif(stddev_pop(CASE WHEN {c} IS NOT NULL THEN pm25 END) * stddev_pop(CASE WHEN pm25 IS NOT NULL THEN {c} END), 0)')} AS {c}"
                for c in ex.CORRELATED
            )
            + " FROM clean"
        ),
        "pm25_describe": _with(
            f"""SELECT count(pm25) AS count, {r('avg(pm25)')} AS mean, {r('stddev_samp(pm25)')} AS stddev,
  min(pm25) AS min, max(pm25) AS max FROM clean"""
        ),
        "pm25_frequency": _with(
            "SELECT pm25, count(*) AS count FROM clean GROUP BY pm25 ORDER BY count DESC, pm25 ASC NULLS FIRST LIMIT 10"
        ),
        # streaming (same answer as the batch filters over the same rows)
        "stream_abnormal": _with(
            f"""SELECT {_SENSOR}, {r('pollution_index')} AS pollution_index, severity
FROM (SELECT *, {_SEVERITY} AS severity FROM raw_i) WHERE severity <> 'NORMALE'"""
        ),
        "stream_alerts": _with(
            f"""SELECT {_SENSOR}, {r('pollution_index')} AS pollution_index, severity
FROM (SELECT *, {_SEVERITY} AS severity FROM raw_i) WHERE severity = 'DANGER'"""
        ),
    }
    # The models' data, and the linear model solved from its moments.
    rows |= {
        "model_split_sizes": _with(ms.SPLIT_SIZES, ms.PREPARED_CTE),
        "trees_replayed": _with(ms.TREES_REPLAYED, ms.PREPARED_CTE),
        "category_codes": _with(ms.CATEGORY_CODES, ms.PREPARED_CTE),
        "feature_rows": _with(ms.FEATURE_ROWS, ms.PREPARED_CTE),
        "ridge_coefficients": _with(ms.RIDGE_COEFFICIENTS, ms.PREPARED_CTE, ms.RIDGE_CTE),
        "ridge_predictions": _with(ms.RIDGE_PREDICTIONS, ms.PREPARED_CTE, ms.RIDGE_CTE),
        "ridge_metrics": _with(ms.RIDGE_METRICS, ms.PREPARED_CTE, ms.RIDGE_CTE),
        "ridge_gradient": _with(ms.RIDGE_GRADIENT, ms.PREPARED_CTE, ms.RIDGE_CTE),
    }
    rows["stream_append"] = rows["stream_abnormal"]
    rows["stream_two_queries"] = _with(
        f"""SELECT feed, severity, count(*) AS rows FROM (SELECT *, {_SEVERITY} AS severity FROM raw_i) r
JOIN (VALUES ('abnormal'), ('alerts')) f(feed) ON severity = 'DANGER' OR (feed = 'abnormal' AND severity = 'ELEVEE')
GROUP BY feed, severity"""
    )
    # The export is read back from its JSON files: same records as the node view.
    rows["network_export"] = rows["city_nodes"]
    rows["network_export_edges"] = rows["city_edges"]
    return rows
