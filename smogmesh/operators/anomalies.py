"""Anomaly detectors: fixed limits, z-score, IQR fences and contextual rules.

Global statistics (means, standard deviations, quartiles) are computed by one
aggregate and fed back as scalar subqueries: Spark runs the aggregate once,
merges the scalar subqueries of one aggregate into a single pass, and hands
the values to every task.  No driver round trip in user code, no cross join,
no unpartitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogmesh.functions.rules import any_rule, context_rules, critical_rules, first_match
from smogmesh.operators import quantiles as qu
from smogmesh.schema import FIXED_NORMAL, IQR_FENCE, QUANTILE_ERROR, Z_LIMIT, ZSCORE_LABELS

ZSCORE_COLUMNS = ("pm25", "pm10", "co2", "no2")


# -- fixed limits -------------------------------------------------------------


def label_fixed(df: DataFrame, rules=None) -> DataFrame:
    return df.withColumn("anomalie_type", first_match(rules or critical_rules(), FIXED_NORMAL))


def fixed_limits(df: DataFrame, rules=None) -> DataFrame:
    """Rows breaking a critical limit, labelled by the first rule they break."""
    return label_fixed(df, rules).filter(F.col("anomalie_type") != FIXED_NORMAL)


def count_by(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


# -- z-score ------------------------------------------------------------------


def global_stats(df: DataFrame, cols: Sequence[str] = ZSCORE_COLUMNS) -> DataFrame:
    """One row: mean and sample standard deviation of each column."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"std_{c}")]
    return df.agg(*aggs)


def _scalars(stats: DataFrame) -> dict[str, Column]:
    # One struct-valued scalar subquery: the one-row aggregate runs once and
    # every field is read from the same result.
    row = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    return {name: row.getField(name) for name in stats.columns}


def with_zscores(df: DataFrame, cols: Sequence[str] = ZSCORE_COLUMNS) -> DataFrame:
    """Absolute z-score per column; null when the deviation is 0 or undefined."""
    s = _scalars(global_stats(df, cols))
    out = df
    for c in cols:
        out = out.withColumn(f"z_{c}", F.abs(F.try_divide(F.col(c) - s[f"mean_{c}"], s[f"std_{c}"])))
    return out


def zscore(
    df: DataFrame,
    cols: Sequence[str] = ZSCORE_COLUMNS,
    *,
    limit: float = Z_LIMIT,
    labels: Sequence[str] = ZSCORE_LABELS,
) -> DataFrame:
    """Rows with |z| > limit in any column, labelled by the first such column."""
    rules = [(lab, F.col(f"z_{c}") > limit) for lab, c in zip(labels, cols)]
    return (
        with_zscores(df, cols)
        .filter(any_rule(rules))
        .withColumn("anomalie_zscore", first_match(rules, FIXED_NORMAL))
    )


# -- IQR ----------------------------------------------------------------------


def quartile_fences(
    df: DataFrame, col: str = "pm25", *, fence: float = IQR_FENCE, exact: bool = True, error: float = QUANTILE_ERROR
) -> DataFrame:
    """One row: q1, q3, iqr and the lower / upper fences of a column (nulls and NaN ignored; all null without values).

    ``exact=True`` selects the order statistics (``percentile_disc``) by narrowing
    value ranges: memory does not grow with rows or distinct values.
    ``exact=False`` reads them off a mergeable sketch with a rank error of at most ``error``.
    """
    if exact:
        found = qu.exact_quantiles(df, col, (0.25, 0.75))
    else:
        found = qu.sketch_quantiles(qu.rank_sketches(df, col, error=error), (0.25, 0.75))
    return (
        found.agg(F.max("q0").alias("q1"), F.max("q1").alias("q3"))
        .withColumn("iqr", F.col("q3") - F.col("q1"))
        .withColumn("lower", F.col("q1") - F.lit(fence) * F.col("iqr"))
        .withColumn("upper", F.col("q3") + F.lit(fence) * F.col("iqr"))
    )


def quartile_rank_errors(df: DataFrame, col: str = "pm25", *, error: float = QUANTILE_ERROR) -> DataFrame:
    """The approximate quartiles of ``exact=False`` with their true rank errors (see ``quantiles.rank_errors``)."""
    probs = (0.25, 0.5, 0.75)
    row = qu.sketch_quantiles(qu.rank_sketches(df, col, error=error), probs).first()
    found = [(p, row[f"q{i}"]) for i, p in enumerate(probs) if row[f"q{i}"] is not None]
    if not found:
        return df.sparkSession.createDataFrame([], "prob double, value double, n long, below long, at_most long, rank_error double")
    return qu.rank_errors(df, col, found)


def iqr(df: DataFrame, col: str = "pm25", *, fence: float = IQR_FENCE, exact: bool = True) -> DataFrame:
    """Rows whose value lies outside the IQR fences."""
    s = _scalars(quartile_fences(df, col, fence=fence, exact=exact).select("lower", "upper"))
    c = F.col(col)
    return df.filter((c < s["lower"]) | (c > s["upper"]))


# -- contextual rules ------------------------------------------------------------


def context_anomalies(df: DataFrame, rules=None) -> DataFrame:
    """Rows breaking a contextual rule, labelled by the first rule they break."""
    rules = rules or context_rules()
    return df.withColumn("anomalie_contexte", first_match(rules)).filter(F.col("anomalie_contexte").isNotNull())


# -- summary ---------------------------------------------------------------------


def summary(df: DataFrame, *, limit: float = Z_LIMIT, fence: float = IQR_FENCE) -> DataFrame:
    """Per method: number of anomalies and share of all rows, in one pass over the data."""
    z = with_zscores(df)
    s = _scalars(quartile_fences(df, "pm25", fence=fence).select("lower", "upper"))
    pm25 = F.col("pm25")
    flags = {
        "fixed_limits": first_match(critical_rules(), FIXED_NORMAL) != FIXED_NORMAL,
        "zscore": any_rule([(c, F.col(f"z_{c}") > limit) for c in ZSCORE_COLUMNS]),
        "iqr": (pm25 < s["lower"]) | (pm25 > s["upper"]),
        "context": any_rule(context_rules()),
    }
    counts = z.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.coalesce(v, F.lit(False))).alias(k) for k, v in flags.items()],
    )
    stack = ", ".join(f"'{k}', `{k}`" for k in flags)
    return counts.selectExpr("total", f"stack({len(flags)}, {stack}) AS (method, anomalies)").select(
        "method",
        "anomalies",
        "total",
        (F.try_divide(F.col("anomalies").cast("double"), F.col("total")) * 100).alias("share_pct"),
    )
