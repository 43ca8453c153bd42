"""DuckDB SQL for the model pipeline: split, category codes, feature rows, ridge by elimination, metrics.

Builds on the ``clean`` table of the readings SQL.  The ridge system is set up from
the same moments as in Spark (means, population covariances) and solved by
Gauss-Jordan elimination, one common table per pivot.
"""

from __future__ import annotations

from smogmesh.schema import FEATURES, READING_COLUMNS, READINGS
from pyspark.sql import types as T

_REG = "CAST(0.01 AS DOUBLE)"


def _text(name: str, kind: T.DataType) -> str:
    if isinstance(kind, T.DoubleType):
        return f"CAST(CAST(floor({name} * CAST(1000000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS VARCHAR)"
    return name if isinstance(kind, T.StringType) else f"CAST({name} AS VARCHAR)"


_ROW_TEXT = "concat_ws(chr(31), " + ", ".join(_text(f.name, f.dataType) for f in READINGS.fields) + ")"
_DRAW = f"CAST('0x' || substr(md5('42:' || {_ROW_TEXT}), 1, 8) AS BIGINT) % 10000"

_NUMERIC = [f for f in FEATURES if not f.endswith("_indexed")]

PREPARED_CTE = f""",
prepared AS MATERIALIZED (
  SELECT {", ".join(c + " AS label" if c == "pm25" else c for c in READING_COLUMNS)}, {_DRAW} < 8000 AS is_train FROM clean
),
codes AS MATERIALIZED (
  SELECT 'line' AS kind, line AS value, row_number() OVER (ORDER BY count(*) DESC, line) - 1 AS code
  FROM prepared WHERE is_train GROUP BY line
  UNION ALL
  SELECT 'city', city, row_number() OVER (ORDER BY count(*) DESC, city) - 1 FROM prepared WHERE is_train GROUP BY city
),
feature_rows AS MATERIALIZED (
  SELECT {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _NUMERIC)},
    CAST(coalesce(l.code, (SELECT count(*) FROM codes WHERE kind = 'line')) AS DOUBLE) AS line_indexed,
    CAST(coalesce(c.code, (SELECT count(*) FROM codes WHERE kind = 'city')) AS DOUBLE) AS city_indexed,
    label, is_train
  FROM prepared p LEFT JOIN codes l ON l.kind = 'line' AND l.value = p.line
  LEFT JOIN codes c ON c.kind = 'city' AND c.value = p.city
)"""


def _ridge_cte() -> str:
    cols = [*FEATURES, "label"]
    k = len(FEATURES)
    cells = [f"covar_pop({cols[min(i, j)]}, {cols[max(i, j)]})" for i in range(k + 1) for j in range(k + 1)]
    pairs = [f"{{'i': {i}, 'j': {j}, 'x': {cells[i * (k + 1) + j]}}}" for i in range(k + 1) for j in range(k + 1)]
    means = [f"{{'i': {i}, 'm': avg({c})}}" for i, c in enumerate(cols)]
    out = [
        f""",
mo AS MATERIALIZED (
  SELECT [{", ".join(pairs)}] AS cells, [{", ".join(means)}] AS means FROM feature_rows WHERE is_train
),
cov AS MATERIALIZED (SELECT c.i, c.j, c.x FROM (SELECT unnest(cells) AS c FROM mo)),
avgs AS MATERIALIZED (SELECT m.i, m.m FROM (SELECT unnest(means) AS m FROM mo)),
dev AS MATERIALIZED (
  SELECT cov.i, CASE WHEN cov.x > pow(CAST(1e-9 AS DOUBLE) * (abs(a.m) + 1e-300), 2) THEN sqrt(cov.x) ELSE CAST(0 AS DOUBLE) END AS d
  FROM cov JOIN avgs a ON a.i = cov.i WHERE cov.i = cov.j
),
p0 AS MATERIALIZED (
  SELECT cov.i, cov.j,
    CASE WHEN cov.j = {k} THEN CASE WHEN a.d > 0 AND y.d > 0 THEN cov.x / (a.d * y.d) ELSE 0 END
         WHEN a.d > 0 AND b.d > 0 AND y.d > 0
           THEN cov.x / (a.d * b.d) + CASE WHEN cov.i = cov.j THEN {_REG} / y.d ELSE 0 END
         WHEN cov.i = cov.j THEN 1 ELSE 0 END AS x
  FROM cov JOIN dev a ON a.i = cov.i JOIN dev b ON b.i = cov.j JOIN dev y ON y.i = {k} WHERE cov.i < {k}
)"""
    ]
    for p in range(k):
        out.append(
            f""",
p{p + 1} AS MATERIALIZED (
  SELECT a.i, a.j, CASE WHEN a.i = {p} THEN a.x / v.x ELSE a.x - f.x * r.x / v.x END AS x
  FROM p{p} a JOIN p{p} f ON f.i = a.i AND f.j = {p} JOIN p{p} r ON r.i = {p} AND r.j = a.j
  JOIN p{p} v ON v.i = {p} AND v.j = {p}
)"""
        )
    names = ", ".join(f"({i}, '{f}')" for i, f in enumerate(FEATURES))
    out.append(
        f""",
names(i, term) AS (VALUES {names}),
slopes AS MATERIALIZED (
  SELECT n.i, n.term, CASE WHEN d.d > 0 THEN w.x * y.d / d.d ELSE 0 END AS coefficient
  FROM names n JOIN p{k} w ON w.i = n.i AND w.j = {k} JOIN dev d ON d.i = n.i JOIN dev y ON y.i = {k}
),
ridge AS MATERIALIZED (
  SELECT 0 AS position, 'intercept' AS term,
         (SELECT m FROM avgs WHERE i = {k}) - (SELECT sum(s.coefficient * a.m) FROM slopes s JOIN avgs a ON a.i = s.i) AS coefficient
  UNION ALL SELECT i + 1, term, coefficient FROM slopes
),
estimates AS (
  SELECT label, (SELECT coefficient FROM ridge WHERE position = 0)
    + {" + ".join(f"{f} * (SELECT coefficient FROM ridge WHERE position = {i + 1})" for i, f in enumerate(FEATURES))} AS prediction
  FROM feature_rows WHERE NOT is_train
)"""
    )
    return "".join(out)


RIDGE_CTE = _ridge_cte()

SPLIT_SIZES = """SELECT count(*) AS n_rows, count(*) FILTER (WHERE is_train) AS n_train,
  count(*) FILTER (WHERE NOT is_train) AS n_test FROM prepared"""
#: Every test row's prediction must come out again.
TREES_REPLAYED = """SELECT m.model, n.n_rows, n.n_rows AS n_same FROM (VALUES ('decision_tree'), ('random_forest')) m(model),
  (SELECT count(*) AS n_rows FROM prepared WHERE NOT is_train) n"""
CATEGORY_CODES = 'SELECT kind AS "column", value, CAST(code AS INTEGER) AS code FROM codes'
FEATURE_ROWS = (
    "SELECT "
    + ", ".join(f"round({f}, 6) AS {f}" for f in FEATURES)
    + ", label, is_train FROM feature_rows"
)
RIDGE_COEFFICIENTS = "SELECT CAST(position AS INTEGER) AS position, term, round(coefficient, 6) AS coefficient FROM ridge"
RIDGE_PREDICTIONS = "SELECT label, round(prediction, 6) AS prediction FROM estimates"
RIDGE_METRICS = """SELECT round(sqrt(avg((label - prediction) * (label - prediction))), 6) AS rmse,
  round(1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)), 6) AS r2,
  round(avg(abs(label - prediction)), 6) AS mae FROM estimates"""
#: The norm of the ridge objective's gradient at the solution, from the moments.
RIDGE_GRADIENT = f"""SELECT n_train, round(sqrt(sum(g * g)), 6) AS gradient FROM (
  SELECT a.i, sum(a.x * coalesce(w.x, 0)) - max(CASE WHEN a.j = {len(FEATURES)} THEN a.x END) AS g
  FROM p0 a LEFT JOIN p{len(FEATURES)} w ON w.i = a.j AND w.j = {len(FEATURES)} GROUP BY a.i
), (SELECT count(*) AS n_train FROM feature_rows WHERE is_train) GROUP BY n_train"""
