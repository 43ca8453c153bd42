"""Exact Lloyd clustering with bounds that are loosened by the norm of total displacement (ns-bounds).

Every vector keeps, per centroid, a distance and the round in which it was
evaluated.  The history of all centroids is kept, so in a later round that
distance is loosened by the norm of the centroid's *total* displacement since
then, which is never more than the sum of the norms of its single moves.  A
centroid whose loosened distance stays above the vector's own upper bound is
skipped; the others are evaluated exactly.  Assignments, ties included, are
those of plain Lloyd rounds.

All distances are compared as whole numbers.  The vectors and their bounds
are one table that each round rewrites; the driver holds the centroid history
only (rounds x centroids x dimensions).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smogmesh.llm.common import Generations

#: Bounds are square roots in doubles; this much covers their rounding.
_SLACK = 1e-12
#: Wide sums travel in pieces of this many bits.
_LIMB = 40
_LONG_MAX = (1 << 63) - 1


def whole_vectors(vectors: DataFrame, key: str, vec: str, dims: int, scale: int) -> DataFrame:
    """``id, y``: vectors of exactly ``dims`` finite components, each as floor(scale * x), x as double.

    ``y`` holds whole numbers as doubles: scaling by a power of two and
    flooring lose nothing, whatever the size (a component that is finite only
    before the scaling counts as non-finite).
    """
    x = F.col(vec)
    fit = (F.size(x) == dims) & ~F.exists(
        x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double") * F.lit(float(scale))) == float("inf"))
    )
    # floor() of a double is a long; doubles from 2**53 on are whole already.
    def down(c):
        s = c.cast("double") * F.lit(float(scale))
        return F.when(F.abs(s) < 2.0**53, F.floor(s).cast("double")).otherwise(s)

    return vectors.filter(F.coalesce(fit, F.lit(False))).select(
        F.col(key).cast("long").alias("id"), F.transform(x, down).alias("y")
    )


def _small(m: np.ndarray, c: list[list[int]]) -> bool:
    """Are all squared distances between rows of ``m`` and centroids ``c`` exact in doubles?"""
    reach = float(np.abs(m).max(initial=0)) + max(abs(v) for row in c for v in row)
    return reach < 2**26 and m.shape[1] * reach * reach < 2**53


def _squares(m: np.ndarray, c: list[int], exact_doubles: bool) -> np.ndarray:
    """Squared distances of the rows of ``m`` to the vector ``c``: doubles, or Python numbers if wide."""
    if exact_doubles:
        d = m - np.array(c, dtype=float)
        return np.einsum("ij,ij->i", d, d)
    out = np.empty(len(m), dtype=object)
    for i, row in enumerate(m):
        out[i] = sum((int(a) - b) ** 2 for a, b in zip(row, c))
    return out


def _root(square: int | float) -> float:
    return math.sqrt(square) if square < 2**1000 else float(math.isqrt(square))


class Bounds:
    """Centroid history and, for the current round, how far each centroid has moved since each earlier one."""

    def __init__(self, history: list[list[list[int]]]):
        self.centroids = history[-1]
        self.now = len(history) - 1
        # Norms of total displacement, from exact differences.
        self.moved = np.array(
            [[_root(sum((a - b) ** 2 for a, b in zip(c, d))) for c, d in zip(cs, history[-1])] for cs in history]
        )

    def assign(self, m: np.ndarray, own: np.ndarray, at: np.ndarray, dist: np.ndarray) -> int:
        """Bring ``own, at, dist`` of the block ``m`` up to this round, in place; distances evaluated."""
        t, k, c = self.now, len(self.centroids), self.centroids
        plain = _small(m, c)
        rows = np.arange(len(m))
        found = np.full((len(m), k), np.inf, dtype=float if plain else object)
        evaluated = 0

        def look(j: int, which: np.ndarray) -> None:
            nonlocal evaluated
            if len(which):
                evaluated += len(which)
                found[which, j] = _squares(m[which], c[j], plain)
                dist[which, j] = np.sqrt(found[which, j]) if plain else [_root(v) for v in found[which, j]]
                at[which, j] = t

        fresh = np.flatnonzero(own < 0)
        for j in range(k):
            look(j, fresh)
        own[fresh] = _least(found[fresh])
        old = np.setdiff1d(rows, fresh, assume_unique=True)
        drift = self.moved[at, np.arange(k)[None, :]] * (1 + _SLACK)
        low = dist * (1 - _SLACK) - drift
        up = dist[rows, own] * (1 + _SLACK) + drift[rows, own]
        low[rows, own] = np.inf
        open_ = old[(low[old] <= up[old, None]).any(axis=1)]
        # First the own distance alone: a tight upper bound settles many.
        for j in range(k):
            look(j, open_[own[open_] == j])
        up[open_] = dist[open_, own[open_]] * (1 + _SLACK)
        need = low[open_] <= up[open_, None]
        for j in range(k):
            look(j, open_[need[:, j]])
        again = open_[need.any(axis=1)]
        own[again] = _least(found[again])
        return evaluated


def _least(found: np.ndarray) -> np.ndarray:
    """The first smallest column of each row."""
    if found.dtype != object:
        return np.argmin(found, axis=1)
    return np.array([min(range(len(r)), key=lambda j: (r[j], j)) for r in found], dtype=np.int64).reshape(len(found))


_STATE = "id long, y array<double>, cluster int, was int, at binary, dist binary, evaluated int"


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("y").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dims)


def _rows_of(m: np.ndarray) -> pa.Array:
    offsets = np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(m).ravel()))


def _cells(m: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in m], pa.binary())


def _round(state: DataFrame, history: list, dims: int) -> DataFrame:
    """The state after one assignment to the last centroids of ``history``."""
    k = len(history[-1])
    shared = state.sparkSession.sparkContext.broadcast(Bounds(history))

    def run(batches: Iterator[pa.RecordBatch]):
        bounds = shared.value
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            m = _matrix(batch, dims)
            was = batch.column("cluster").to_numpy().astype(np.int64)
            at = np.frombuffer(b"".join(batch.column("at").to_pylist()), dtype="<i4").reshape(n, k).copy()
            dist = np.frombuffer(b"".join(batch.column("dist").to_pylist()), dtype="<f8").reshape(n, k).copy()
            own = was.copy()
            evaluated = bounds.assign(m, own, at, dist)
            share = np.zeros(n, dtype=np.int32)
            share[0] = evaluated
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("y"), pa.array(own.astype(np.int32)), pa.array(was.astype(np.int32)),
                    _cells(at), _cells(dist), pa.array(share),
                ],
                names=["id", "y", "cluster", "was", "at", "dist", "evaluated"],
            )

    return state.mapInArrow(run, _STATE)


def _change(state: DataFrame, k: int, dims: int) -> tuple[list[list[int]], list[int]]:
    """What the last assignment added to each cluster's sums and sizes, as exact whole numbers.

    Only rows that changed their cluster count: added to the new one, taken
    from the old one.  Each task sums its own rows; at most clusters x
    dimensions x pieces rows per task are shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        cells: dict[tuple[int, int], list] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch, dims)
            to, was = batch.column("cluster").to_numpy(), batch.column("was").to_numpy()
            wide = np.abs(m).max(initial=0) * batch.num_rows >= 2.0**53
            for j in range(k):
                for sign, rows in ((1, to == j), (-1, was == j)):
                    n = int(rows.sum())
                    if not n:
                        continue
                    s = [sum(map(int, c)) for c in m[rows].T] if wide else [int(v) for v in m[rows].sum(axis=0)]
                    for d, v in enumerate(s):
                        cells[j, d] = cells.get((j, d), 0) + sign * v
                    cells[j, -1] = cells.get((j, -1), 0) + sign * n
        out = []
        for (j, d), v in cells.items():
            limb = 0
            while v:
                low = v if -(1 << _LIMB) < v < 1 << _LIMB else v % (1 << _LIMB)
                out.append((j, d, limb, low))
                v, limb = (v - low) >> _LIMB, limb + 1
        if out:
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int32()) for c in cols[:3]), pa.array(cols[3], pa.int64())], names=["j", "d", "limb", "s"]
            )

    moved = state.filter("cluster <> was").select("y", "cluster", "was")
    parts = moved.mapInArrow(run, "j int, d int, limb int, s long")
    sums, sizes = [[0] * dims for _ in range(k)], [0] * k
    # Whole-number sums of at most 2**40 a task, bounded in number by k, dims and pieces.
    for r in parts.groupBy("j", "d", "limb").agg(F.sum("s").alias("s")).collect():
        v = r["s"] << (_LIMB * r["limb"])
        if r["d"] < 0:
            sizes[r["j"]] += v
        else:
            sums[r["j"]][r["d"]] += v
    return sums, sizes


def _final(state: DataFrame, centroids: list[list[int]], dims: int) -> DataFrame:
    """``id, cluster, distance`` with the exact squared distance; null where 64 bits do not hold it."""
    shared = state.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]):
        c = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch, dims)
            own = batch.column("cluster").to_numpy()
            plain = _small(m, c)
            out: list = [None] * batch.num_rows
            for j in np.unique(own):
                at = np.flatnonzero(own == j)
                for i, v in zip(at, _squares(m[at], c[j], plain)):
                    out[i] = int(v) if v <= _LONG_MAX else None
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("cluster"), pa.array(out, pa.int64())], names=["id", "cluster", "distance"]
            )

    return state.select("id", "y", "cluster").mapInArrow(run, "id long, cluster int, distance long")


def clusters(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vec: str = "embedding",
    dims: int = 64,
    k: int = 8,
    rounds: int = 10,
    salt: str = "3",
    scale: int = 1024,
) -> tuple[DataFrame, list[list[int]], list[int]]:
    """Lloyd's clustering: ``(key, cluster, distance)`` rows, the final centroids, distances evaluated per round.

    Vectors of exactly ``dims`` components, none of them null or non-finite,
    take part, each component as floor(``scale`` * x).  The centroids start as
    the ``k`` vectors whose ``salt:key`` has the smallest sha256 (all, if there are
    fewer); each of ``rounds`` rounds assigns every vector to the nearest centroid
    (ties: the smaller number) and replaces the centroids that have vectors
    by floor(sum / count); then vectors are assigned once more.

    Rows that repeat a key take part each; rows without a key take part but
    start no centroid; a table without vectors (or without keyed ones) gives
    no rows and no centroids.  Columns other than key and vec are ignored.  Squared
    distances beyond 64 bits are null, the assignments are exact all the same.
    """
    spark: SparkSession = vectors.sparkSession
    tables = Generations(spark, "clustering")
    kept = whole_vectors(vectors, key, vec, dims, scale)
    seed = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    first = kept.filter("id is not null").select(seed.alias("h"), "y").orderBy("h", "y").limit(k).collect()
    history = [[[int(v) for v in r["y"]] for r in first]]
    k = len(first)
    if not k:
        return spark.createDataFrame([], f"{key} long, cluster int, distance long"), [], []
    unset = bytes(4 * k), bytes(8 * k)
    state = kept.select(
        "id", "y", F.lit(-1).alias("cluster"), F.lit(-1).alias("was"),
        F.lit(unset[0]).alias("at"), F.lit(unset[1]).alias("dist"), F.lit(0).alias("evaluated"),
    )
    sums, sizes, work = [[0] * dims for _ in range(k)], [0] * k, []
    for t in range(rounds + 1):
        state = tables.keep(_round(state, history, dims))
        work.append(state.agg(F.sum("evaluated")).first()[0] or 0)
        if t == rounds:
            break
        more, n = _change(state, k, dims)
        if t and not any(n) and not any(map(any, more)) and state.filter("cluster <> was").isEmpty():
            # Nothing moved: every further round would repeat this one.
            if history[-1] == _means(sums, sizes, history[-1]):
                break
        sums = [[a + b for a, b in zip(s, d)] for s, d in zip(sums, more)]
        sizes = [a + b for a, b in zip(sizes, n)]
        history.append(_means(sums, sizes, history[-1]))
    return _final(state, history[-1], dims).withColumnRenamed("id", key), history[-1], work


def _means(sums: list[list[int]], sizes: list[int], before: list[list[int]]) -> list[list[int]]:
    """floor(sum / count) of each cluster; one without vectors keeps its centroid."""
    return [[v // n for v in s] if n else list(c) for s, n, c in zip(sums, sizes, before)]


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Adds ``cluster_inertia``, ``inertia`` (distances summed over a cluster and over all; null beyond 64 bits)
    and ``centroid_sha256``.  The joined side has one row per centroid."""
    spark = assigned.sparkSession
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    some = {r["cluster"]: r for r in assigned.groupBy("cluster").agg(total.alias("s"), F.count_if(F.isnull("distance")).alias("u")).collect()}

    def fits(parts: list) -> int | None:
        if any(r["u"] for r in parts):
            return None
        s = sum(int(r["s"]) for r in parts)
        return s if s <= _LONG_MAX else None

    everything = fits(list(some.values()))
    rows = [(j, fits([some[j]]), everything, centroid_digest(centroids[j])) for j in sorted(some)]
    side = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(side), "cluster")
