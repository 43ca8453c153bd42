"""Exact top-k by inner product: branch and bound over blocks of dimensions.

Vectors are kept column by column.  For a block of queries against a block of
candidates, products are added up one block of dimensions at a time; after
each, what the remaining dimensions can still add is bounded by the two
remaining lengths (Cauchy-Schwarz), and candidates that cannot reach the k-th
best any more are dropped and the columns compacted.  All arithmetic is on
whole numbers, so scores are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogmesh.llm.common import written

_LONG_MAX = (1 << 63) - 1


def scaled(vectors: DataFrame, key: str, vec: str, scale: int = 1024) -> DataFrame:
    """``id, q``: components as floor(scale * x), x as double; whole numbers of any size, as doubles.

    Vectors that are null or hold a null or non-finite component (also one that is
    finite before the scaling only) are left out.
    """
    x = F.col(vec)

    def times(c):
        return c.cast("double") * F.lit(float(scale))

    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(times(c)) == float("inf")))
    # Doubles from 2**53 on are whole already; floor() is a long.
    whole = F.transform(x, lambda c: F.when(F.abs(times(c)) < 2.0**53, F.floor(times(c)).cast("double")).otherwise(times(c)))
    return vectors.filter(x.isNotNull()).filter(~bad).select(F.col(key).cast("long").alias("id"), whole.alias("q"))


_BLOCK = pa.schema([("ids", pa.binary()), ("dims", pa.int32()), ("cols", pa.binary())])


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Vertical blocks: up to ``size`` vectors' ids and their columns, one column after the other.

    Vectors shorter than the block's longest are filled with zeros.  Columns are 32-bit whole
    numbers, or doubles if a component needs more.
    """

    def block(ids: list[int], vecs: list[list[float]]) -> pa.RecordBatch:
        dims = max(map(len, vecs))
        m = np.zeros((len(vecs), dims))
        for i, v in enumerate(vecs):
            m[i, : len(v)] = v
        narrow = np.abs(m).max(initial=0) < 2.0**31
        cols = np.ascontiguousarray(m.T).astype("<i4" if narrow else "<f8").tobytes()
        return pa.RecordBatch.from_pydict(
            {"ids": [np.array(ids, dtype="<i8").tobytes()], "dims": [dims], "cols": [cols]}, schema=_BLOCK
        )

    def run(batches: Iterator[pa.RecordBatch]):
        ids, vecs = [], []
        for batch in batches:
            ids += batch.column("id").to_pylist()
            vecs += batch.column("q").to_pylist()
            while len(ids) >= size:
                yield block(ids[:size], vecs[:size])
                ids, vecs = ids[size:], vecs[size:]
        if ids:
            yield block(ids, vecs)

    return rows.mapInArrow(run, "ids binary, dims int, cols binary")


def _columns(cols: bytes, dims: int, n: int, wide: int) -> np.ndarray:
    m = np.zeros((wide, n))
    m[:dims] = np.frombuffer(cols, dtype="<i4" if len(cols) == 4 * dims * n else "<f8").reshape(dims, n)
    return m


class Search:
    """The best ``k`` so far of one block of queries."""

    def __init__(self, ids: np.ndarray, cols: bytes, dims: int, k: int):
        self.ids, self.cols, self.dims, self.k = ids, cols, dims, k
        #: Per query the best (-score, id), in order.
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]
        #: What a candidate must reach to matter: the k-th best score so far.
        self.floor = np.full(len(ids), -np.inf)

    def add(self, c_ids: np.ndarray, c_cols: bytes, c_dims: int, step: int) -> None:
        dims = max(self.dims, c_dims, 1)
        q = _columns(self.cols, self.dims, len(self.ids), dims)
        c = _columns(c_cols, c_dims, len(c_ids), dims)
        # Exact in doubles while every partial sum stays below 2**53, else with Python's whole numbers.
        plain = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * dims < 2.0**53
        # Dimensions in which the queries are longest come first: the bound shrinks fastest.
        order = np.argsort(-(q.astype(float) ** 2).sum(axis=1), kind="stable")
        q, c = q[order], c[order]
        q_rest = np.sqrt(np.cumsum((q.astype(float) ** 2)[::-1], axis=0)[::-1])
        c_rest = np.sqrt(np.cumsum((c.astype(float) ** 2)[::-1], axis=0)[::-1])
        if not plain:
            q, c = (np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape) for m in (q, c))
        alive = np.arange(len(c_ids))
        part = np.zeros((len(self.ids), len(c_ids)), dtype=q.dtype)
        for lo in range(0, dims, step):
            hi = min(dims, lo + step)
            part += q[lo:hi].T @ c[lo:hi]
            if hi < dims:
                # A hair above the true length covers the rounding of the square roots.
                # (and, for wide numbers, that of the partial sums).
                rest = q_rest[hi][:, None] * c_rest[hi][None, :] * (1 + 1e-9) + 1e-6
                reach = part + rest if plain else part.astype(float) * (1 + 1e-12 * np.sign(part.astype(float))) + rest
                keep = (reach >= self.floor[:, None]).any(axis=0)
                if keep.sum() < 0.75 * len(alive):
                    alive, c, part, c_rest = alive[keep], c[:, keep], part[:, keep], c_rest[:, keep]
                    if not len(alive):
                        return
        for i in range(len(self.ids)):
            at = np.flatnonzero(part[i] >= self.floor[i])
            if plain and len(at) > 4 * self.k:
                # One more than k: the query itself may be among them.
                far = len(at) - self.k - 1
                at = at[part[i][at] >= np.partition(part[i][at], far)[far]]
            own = self.ids[i]
            found = [(-int(part[i][x]), int(c_ids[alive[x]])) for x in at if c_ids[alive[x]] != own]
            if found:
                self.best[i] = sorted(self.best[i] + found)[: self.k]
                if len(self.best[i]) == self.k:
                    # Just below the score: a double may round it up.
                    self.floor[i] = np.nextafter(float(-self.best[i][-1][0]), -np.inf)


def _ordered(scores: list[int]) -> list[pa.Array]:
    """Scores as longs (null beyond 64 bits), the side on which they leave that range, and a text that sorts those that do."""
    side = [1 if s > _LONG_MAX else -1 if s < ~_LONG_MAX else 0 for s in scores]
    # Numbers of at most 700 digits: components are finite doubles.
    far = [f"{s + 10**700 * (s < 0):0700d}" if x else None for s, x in zip(scores, side)]
    fits = [None if x else s for s, x in zip(scores, side)]
    return [pa.array(fits, pa.int64()), pa.array(side, pa.int32()), pa.array(far, pa.string())]


def top_k(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vec: str = "embedding",
    k: int = 10,
    every: int = 100,
    block: int = 4096,
    query_block: int = 512,
    step: int = 8,
) -> DataFrame:
    """Each query's ``k`` highest integer inner products: ``query_id, rank, vec_id, score``.

    Queries are the rows whose key ``every`` divides; candidates are all rows
    with another key.  Ties go to the smaller key; rows that repeat a key are
    candidates each.  Rows with a null key take no part, nor do vectors that
    are null or hold a null or non-finite component; columns beyond key and
    vec are ignored.  Shorter vectors count as filled with zeros.  Scores are
    ranked as whole numbers of any size; one beyond 64 bits is given as null.

    Blocks of candidates stay where they are read; every block of queries is
    sent to each of a number of groups of candidate blocks, and a task keeps
    the best k per query over the candidate blocks that it meets.
    """
    own = scaled(vectors.filter(F.col(key).isNotNull()), key, vec)
    spark = vectors.sparkSession
    c_blocks = written(_blocks(own, block), "topk-candidates")
    queries = own.filter(F.pmod("id", F.lit(every)) == 0)
    n_groups = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Queries gather into full blocks over a hash of the key, not in one place.
    q_rows = queries.repartition(max(1, n_groups // 12), "id")
    q_blocks = written(_blocks(q_rows, query_block).withColumn("qb", F.monotonically_increasing_id()), "topk-queries")
    groups = F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))
    left = c_blocks.select(
        F.pmod(F.xxhash64(F.substring("ids", 1, 64)), F.lit(n_groups)).cast("int").alias("g"),
        F.lit(-1).cast("long").alias("qb"), "ids", "dims", "cols",
    )
    right = q_blocks.select(groups.alias("g"), "qb", "ids", "dims", "cols")
    both = left.unionByName(right).repartition(n_groups, "g").sortWithinPartitions("g", F.col("qb").desc())

    def run(batches: Iterator[pa.RecordBatch]):
        # Within a group the query blocks come first, then the candidate blocks (qb = -1).
        group, searches = None, []

        def results():
            q_out, c_out, s_out = [], [], []
            for s in searches:
                for q, best in zip(s.ids.tolist(), s.best):
                    q_out += [q] * len(best)
                    c_out += [i for _, i in best]
                    s_out += [-n for n, _ in best]
            if q_out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_out, pa.int64()), pa.array(c_out, pa.int64())] + _ordered(s_out),
                    names=["query_id", "vec_id", "score", "side", "far"],
                )

        for batch in batches:
            for r in batch.to_pylist():
                if r["g"] != group:
                    yield from results()
                    group, searches = r["g"], []
                ids = np.frombuffer(r["ids"], dtype="<i8")
                if r["qb"] >= 0:
                    searches.append(Search(ids, r["cols"], r["dims"], k))
                else:
                    for s in searches:
                        s.add(ids, r["cols"], r["dims"], step)
        yield from results()

    part = both.mapInArrow(run, "query_id long, vec_id long, score long, side int, far string")
    best = Window.partitionBy("query_id").orderBy(F.col("side").desc(), F.col("far").desc(), F.col("score").desc(), "vec_id")
    return (
        part.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
