"""Quantiles of any column at any size: exact selection by narrowing value ranges, and rank sketches.

Exact selection never holds values.  A first pass counts values per power-of-two
grid cell (a fixed number of cells per octave, the same for every group);
the cell that holds a wanted rank is then cut into equal bins, counted,
narrowed to the bin that holds the rank, and so on until smallest and
largest value of the range are equal.  Every pass is one aggregate with partial sums
in the tasks; what is shuffled, and any task's state, is bounded by the number
of bins, not by the number of rows or distinct values.  As the doubles
of a cell are evenly spaced, at most ``1 + ceil(50 / log2(bins))`` passes are needed.

With groups, the ranges to look into are one row per group.  As long as they
are few they go to every task; beyond that, equal values are merged first
and rows meet their group's range by group *and* hash of the value, so a
group that holds most of the rows is spread over many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogmesh.session import cut_lineage

#: Grid cells per octave of the first pass.
_CELLS = 64
#: Number of a value's cell is within this distance of 0.
_CELL_SPAN = 100_000
#: Groups whose ranges go to every task (each a few dozen bytes).
BROADCAST_GROUPS = 100_000
#: Parts that a group's rows are dealt over when ranges are joined.
_SALTS = 64


def _cell(v: Column) -> Column:
    """Order-preserving cell number: octaves cut into equal steps of the logarithm, mirrored for negatives."""
    step = F.floor(F.log2(F.abs(v)) * _CELLS) + F.lit(_CELL_SPAN)
    far = F.lit(2 * _CELL_SPAN)
    size = F.when(F.abs(v) == float("inf"), far).otherwise(step)
    return F.when(v == 0, F.lit(0)).when(v > 0, size).otherwise(-size).cast("int")


def _bin(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Number of the equal bin of ``lo..hi`` that holds ``v``; grows with ``v``."""
    place = F.floor((v - lo) / (hi - lo) * bins)
    return F.least(place, F.lit(bins - 1)).cast("int")


def _disc_rank(n: Column, p: float) -> list[Column]:
    """Rank (from 1) of the smallest value whose cumulative share reaches ``p``."""
    up = F.ceil(F.lit(p) * n)
    rank = F.when((up - 1) / n >= p, up - 1).otherwise(up)
    return [F.greatest(rank, F.lit(1)).cast("long")]


def _linear_ranks(n: Column, p: float) -> list[Column]:
    """Ranks of the two values that linear interpolation lies between."""
    at = F.lit(p) * (n - 1)
    return [(F.floor(at) + 1).cast("long"), (F.ceil(at) + 1).cast("long")]


def _counted(rows: DataFrame, by: Sequence[str], targets: int, bucket: list[Column]) -> DataFrame:
    """Per group, target and bucket: rows, smallest and largest value.  Rows outside a target's range have no bucket."""
    looks = F.array(*[F.struct(F.lit(i).alias("t"), bucket[i].alias("b")) for i in range(targets)])
    seen = rows.select(*by, "_v", "_n", F.explode(F.filter(looks, lambda x: x["b"].isNotNull())).alias("_x"))
    return seen.groupBy(*by, F.col("_x.t").alias("_t"), F.col("_x.b").alias("_b")).agg(
        F.sum("_n").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )


def _hit(hist: DataFrame, by: Sequence[str], rank: Column, below: Column) -> DataFrame:
    """The bucket of each group and target in which the rank lies: ``_t, _k (rank inside), _lo, _hi``.

    A group and target have at most as many rows here as there are buckets.
    """
    order = Window.partitionBy(*by, "_t").orderBy("_b")
    before = F.coalesce(F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + below
    placed = hist.withColumn("_before", before).withColumn("_rank", rank)
    inside = (F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_before") + F.col("_c"))
    return placed.filter(inside).select(*by, "_t", (F.col("_rank") - F.col("_before")).alias("_k"), "_lo", "_hi")


def _wide(hit: DataFrame, by: Sequence[str], targets: int) -> DataFrame:
    """One row per group: ``_k0, _lo0, _hi0, _k1, ...``."""
    aggs = []
    for i in range(targets):
        own = F.col("_t") == i
        for c in ("_k", "_lo", "_hi"):
            aggs.append(F.max(F.when(own, F.col(c))).alias(f"{c}{i}"))
    return hit.groupBy(*by).agg(*aggs)


def _values(df: DataFrame, col: str, by: Sequence[str]) -> DataFrame:
    v = F.col(col).cast("double")
    keys = [F.col(c).alias(f"_g{i}") for i, c in enumerate(by)]
    return df.select(*keys, v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v")).withColumn("_n", F.lit(1))


def _ranked(cells: DataFrame, by: Sequence[str], rank_of) -> tuple[DataFrame, list]:
    """First-pass cells repeated per target, with each target's rank from the group's row count."""
    total = F.sum("_c").over(Window.partitionBy(*by)) if by else F.sum("_c").over(Window.partitionBy(F.lit(0)))
    sized = cells.withColumn("_total", total)
    ranks = rank_of(F.col("_total"))
    looks = F.array(*[F.struct(F.lit(i).alias("t"), r.alias("r")) for i, r in enumerate(ranks)])
    out = sized.withColumn("_x", F.explode(looks))
    return out.withColumn("_t", F.col("_x.t")).withColumn("_r", F.col("_x.r")).drop("_x"), ranks


def select_ranks(
    df: DataFrame,
    col: str,
    rank_of,
    *,
    by: Sequence[str] = (),
    bins: int = 1024,
    broadcast_groups: int = BROADCAST_GROUPS,
) -> DataFrame:
    """Exact order statistics: one row per group with ``by``, ``n`` and a double ``v0, v1, ...`` per rank.

    ``rank_of(n)`` gives the ranks (from 1) as columns of the group's number of
    values.  Nulls and NaN are ignored; groups without other values are left
    out, and without groups a table without values gives no row.  Null keys
    form a group.  Runs one job per pass.
    """
    keys = [f"_g{i}" for i in range(len(by))]
    rows = _values(df, col, by)
    cells = rows.groupBy(*keys, _cell(F.col("_v")).alias("_b")).agg(
        F.sum("_n").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    cells = cut_lineage(cells)
    ranked, ranks = _ranked(cells, keys, rank_of)
    targets = len(ranks)
    hit = _hit(ranked, keys, F.col("_r"), F.lit(0))
    state = cut_lineage(_wide(hit, keys, targets))
    if keys:
        totals = cells.groupBy(*keys).agg(F.sum("_c").alias("_total"))
        found = _narrow_groups(rows, state, keys, targets, bins, broadcast_groups)
        same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
        on = same[0]
        for s in same[1:]:
            on = on & s
        joined = found.alias("a").join(totals.alias("b"), on)
        names = [F.col(f"a.{k}").alias(c) for k, c in zip(keys, by)]
        return joined.select(*names, F.col("_total").alias("n"), *[F.col(f"_lo{i}").alias(f"v{i}") for i in range(targets)])
    row = state.first()
    total = cells.agg(F.sum("_c")).first()[0]
    schema = "n long, " + ", ".join(f"v{i} double" for i in range(targets))
    if total is None:
        return df.sparkSession.createDataFrame([], schema)
    values = _narrow(rows, row.asDict(), targets, bins)
    return df.sparkSession.createDataFrame([(total, *values)], schema)


def _narrow(rows: DataFrame, state: dict, targets: int, bins: int) -> list[float]:
    """Without groups: the ranges are literals, the counts of a pass (bins per target) come to the driver."""
    while True:
        open_ = [i for i in range(targets) if state[f"_lo{i}"] < state[f"_hi{i}"]]
        if not open_:
            return [state[f"_lo{i}"] for i in range(targets)]
        v = F.col("_v")
        buckets = []
        for i in open_:
            lo, hi = F.lit(state[f"_lo{i}"]), F.lit(state[f"_hi{i}"])
            buckets.append(F.when(v.between(lo, hi), _bin(v, lo, hi, bins)))
        any_range = None
        for i in open_:
            inside = v.between(state[f"_lo{i}"], state[f"_hi{i}"])
            any_range = inside if any_range is None else any_range | inside
        hist = _counted(rows.filter(any_range), [], len(open_), buckets).collect()
        for t, i in enumerate(open_):
            before = 0
            for r in sorted((r for r in hist if r["_t"] == t), key=lambda r: r["_b"]):
                if state[f"_k{i}"] <= before + r["_c"]:
                    state |= {f"_k{i}": state[f"_k{i}"] - before, f"_lo{i}": r["_lo"], f"_hi{i}": r["_hi"]}
                    break
                before += r["_c"]


def _narrow_groups(
    rows: DataFrame, state: DataFrame, keys: list[str], targets: int, bins: int, broadcast_groups: int
) -> DataFrame:
    """With groups: the ranges are a table with one row per group, rewritten after every pass."""
    unset = None
    for i in range(targets):
        wide = F.col(f"_lo{i}") < F.col(f"_hi{i}")
        unset = wide if unset is None else unset | wide
    merged = False
    v = F.col("_v")
    while True:
        todo = state.filter(unset)
        n_open = todo.count()
        if not n_open:
            return state
        if n_open <= broadcast_groups:
            side, on = F.broadcast(todo.select(*[F.col(k).alias(f"{k}_") for k in keys], *_range_columns(targets))), []
        else:
            if not merged:
                # Equal values of a group become one row: a value that most rows hold is no hot key below.
                rows = cut_lineage(rows.groupBy(*keys, "_v").agg(F.sum("_n").alias("_n")))
                rows = rows.withColumn("_salt", F.pmod(F.xxhash64("_v"), F.lit(_SALTS)).cast("int"))
                merged = True
            salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt_")
            side = todo.select(*[F.col(k).alias(f"{k}_") for k in keys], *_range_columns(targets), salts)
            on = [F.col("_salt") == F.col("_salt_")]
        cond = None
        for c in [*[F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys], *on]:
            cond = c if cond is None else cond & c
        met = rows.join(side, cond)
        buckets = []
        for i in range(targets):
            lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
            buckets.append(F.when((lo < hi) & v.between(lo, hi), _bin(v, lo, hi, bins)))
        hist = _counted(met, keys, targets, buckets)
        ranks = state.select(*keys, F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col(f"_k{i}").alias("r")) for i in range(targets)])).alias("_y"))
        ranks = ranks.select(*[F.col(k).alias(f"{k}_") for k in keys], F.col("_y.t").alias("_ty"), F.col("_y.r").alias("_ry"))
        cond = F.col("_t") == F.col("_ty")
        for k in keys:
            cond = cond & F.col(k).eqNullSafe(F.col(f"{k}_"))
        hit = _hit(hist.join(ranks, cond), keys, F.col("_ry"), F.lit(0))
        # Ranges that were closed before stay as they are.
        kept = state.select(*keys, F.explode(F.array(*[
            F.struct(F.lit(i).alias("t"), F.col(f"_k{i}").alias("k"), F.col(f"_lo{i}").alias("lo"), F.col(f"_hi{i}").alias("hi"))
            for i in range(targets)
        ])).alias("_y")).filter("_y.lo >= _y.hi")
        kept = kept.select(*keys, F.col("_y.t").alias("_t"), F.col("_y.k").alias("_k"), F.col("_y.lo").alias("_lo"), F.col("_y.hi").alias("_hi"))
        state = cut_lineage(_wide(hit.unionByName(kept), keys, targets))


def _range_columns(targets: int) -> list[str]:
    return [f"{c}{i}" for i in range(targets) for c in ("_lo", "_hi")]


def exact_quantiles(
    df: DataFrame,
    col: str,
    probs: Sequence[float],
    *,
    by: Sequence[str] = (),
    interpolate: bool = False,
    bins: int = 1024,
    broadcast_groups: int = BROADCAST_GROUPS,
) -> DataFrame:
    """Exact quantiles: ``by``, ``n`` and a double ``q0, q1, ...`` per probability, one row per group.

    By default the smallest value whose cumulative share reaches the
    probability (``percentile_disc``); with ``interpolate`` the linear
    interpolation between the two neighbouring values (``percentile``).
    Nulls and NaN are ignored, as are groups without other values.
    """
    for p in probs:
        if not 0.0 <= p <= 1.0:
            raise ValueError(f"a probability lies between 0 and 1, not {p}")
    per = _linear_ranks if interpolate else _disc_rank

    def rank_of(n: Column) -> list[Column]:
        return [r for p in probs for r in per(n, p)]

    found = select_ranks(df, col, rank_of, by=by, bins=bins, broadcast_groups=broadcast_groups)
    out = []
    for i, p in enumerate(probs):
        if not interpolate:
            out.append(F.col(f"v{i}").alias(f"q{i}"))
            continue
        low, high = F.col(f"v{2 * i}"), F.col(f"v{2 * i + 1}")
        at = F.lit(p) * (F.col("n") - 1)
        part = at - F.floor(at)
        out.append(F.when(low == high, low).otherwise((1 - part) * low + part * high).alias(f"q{i}"))
    return found.select(*by, "n", *out)


# -- rank sketches ----------------------------------------------------------------------


def sketch_size(error: float) -> int:
    """Sketch parameter for a rank error of at most ``error`` (with a wide margin)."""
    return max(8, min(65_535, math.ceil(8 / error)))


def rank_sketches(df: DataFrame, col: str, *, by: Sequence[str] = (), error: float = 0.01) -> DataFrame:
    """One mergeable rank sketch per group: ``by``, ``n`` and a binary ``sketch`` of a few kilobytes.

    Sketches can be stored per day or per partition and merged later
    (``merged_sketches``).  Nulls and NaN are ignored.
    """
    v = F.col(col).cast("double")
    usable = df.filter(v.isNotNull() & ~F.isnan(v))
    sketch = F.kll_sketch_agg_double(v, F.lit(sketch_size(error)))
    return usable.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), sketch.alias("sketch"))


def merged_sketches(sketches: DataFrame, *, by: Sequence[str] = ()) -> DataFrame:
    """Sketches merged into coarser groups, without the rows they came from."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float], *, by: Sequence[str] = ()) -> DataFrame:
    """Approximate quantiles of sketches: ``by``, ``n`` and a double ``q0, q1, ...`` per probability (null if empty)."""
    out = [
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(p)))).alias(f"q{i}")
        for i, p in enumerate(probs)
    ]
    return sketches.select(*by, "n", *out)


def rank_errors(df: DataFrame, col: str, answers: Sequence[tuple[float, float]]) -> DataFrame:
    """True rank error of claimed quantiles ``(probability, value)``, from exact counts in one pass.

    ``prob, value, n, below, at_most, rank_error``: the error is the distance
    of the probability from the shares of values below and up to ``value``.
    """
    v = F.col(col).cast("double")
    usable = df.filter(v.isNotNull() & ~F.isnan(v))
    counts = [F.count(F.lit(1)).alias("n")]
    for i, (_, value) in enumerate(answers):
        counts += [F.count_if(v < F.lit(float(value))).alias(f"b{i}"), F.count_if(v <= F.lit(float(value))).alias(f"a{i}")]
    one = usable.agg(*counts)
    cells = [
        F.struct(
            F.lit(float(p)).alias("prob"), F.lit(float(value)).alias("value"), F.col("n"),
            F.col(f"b{i}").alias("below"), F.col(f"a{i}").alias("at_most"),
        )
        for i, (p, value) in enumerate(answers)
    ]
    flat = one.select(F.inline(F.array(*cells)))
    low, high = F.try_divide("below", "n"), F.try_divide("at_most", "n")
    miss = F.greatest(low - F.col("prob"), F.col("prob") - high, F.lit(0.0))
    return flat.withColumn("rank_error", miss)
