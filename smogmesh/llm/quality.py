"""Document quality by nearest-neighbour voting in a latent-semantic space.

Texts become term vectors: byte trigrams, word shapes ("Aa", "A!", "a*", ...) and
repetition terms (a word like the one before it, a word pair or a line seen
before in the text), each field in square-root proportions, times the
terms' inverse document frequencies over the whole corpus.  A singular value
decomposition of labelled documents' vectors gives the latent space; labelled
documents are broadcast in it.  Every document is folded in, its cosines
with all labelled documents are computed in blocks, and the labels of the
nearest ones vote, weighted by their similarity.

Latent coordinates are rounded to whole 2048ths, so all cosine products are
exact in single precision: the vote does not depend on how rows are batched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogmesh.llm.common import byte_codes, mix64, prefix_sums, span_hash, text_batches
from smogmesh.llm.units import joined

TRIGRAMS, SHAPES, REPEATS = 4096, 512, 6
TERMS = TRIGRAMS + SHAPES + REPEATS
#: Share of each field in a vector's length.
WEIGHTS = (0.3, 1.0, 2.0)
#: Latent coordinates are whole multiples of 1 / GRID; GRID**2 stays below 2**24.
GRID = 2048
#: Rows of a dense block.
BLOCK = 256

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123] = _CLASS[128:] = ord("a")
_CLASS[65:91] = ord("A")
_CLASS[48:58] = ord("0")


def _first_seen(owner: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Mask of the first occurrence of each hash within its owner."""
    both = mix64(h ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    first = np.zeros(len(h), dtype=bool)
    first[np.unique(both, return_index=True)[1]] = True
    return first


def _stretches(inside: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true positions; a position in ``fresh`` always starts one."""
    new = inside.copy()
    new[1:] &= ~inside[:-1] | fresh[1:]
    starts = np.flatnonzero(new)
    stop = np.ones(len(inside), dtype=bool)
    stop[:-1] = ~inside[1:] | fresh[1:]
    return starts, np.flatnonzero(inside & stop) + 1


def term_counts(texts: list[str]) -> np.ndarray:
    """How often each term occurs in each text, one row per text."""
    n = len(texts)
    data, bounds = joined(texts)
    out = np.zeros((n, TERMS))
    if not len(data):
        return out
    of = np.repeat(np.arange(n), np.diff(bounds))
    fresh = np.zeros(len(data), dtype=bool)
    fresh[bounds[:-1][np.diff(bounds) > 0]] = True

    def add(owner: np.ndarray, term: np.ndarray, base: int, width: int) -> None:
        counts = np.bincount(owner * width + term, minlength=n * width)
        out[:, base : base + width] += counts.reshape(n, width)

    if len(data) > 2:
        wide = data.astype(np.uint32)
        code = (wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]) * np.uint32(2654435761)
        at = np.flatnonzero(of[:-2] == of[2:])
        add(of[at], (code[at] >> np.uint32(20)).astype(np.int64), 0, TRIGRAMS)

    codes = byte_codes()
    sums = prefix_sums(data, codes)
    starts, ends = _stretches(data != 10, fresh)
    owner = of[starts]
    line = span_hash(sums, starts, ends)
    add(owner, np.where(_first_seen(owner, line), 5, 4), TRIGRAMS + SHAPES, REPEATS)

    starts, ends = _stretches(~_SPACE[data], fresh)
    if len(starts):
        owner = of[starts]
        # Shapes: classes of a word's bytes, runs of one class collapsed.
        cls = _CLASS[data]
        keep = ~_SPACE[data]
        keep[1:] &= (cls[1:] != cls[:-1]) | _SPACE[data[:-1]] | fresh[1:]
        place = np.cumsum(keep) - 1
        slim = cls[keep]
        shape = span_hash(prefix_sums(slim, codes), place[starts], place[ends - 1] + 1)
        add(owner, (shape % np.uint64(SHAPES)).astype(np.int64), TRIGRAMS, SHAPES)

        word = span_hash(sums, starts, ends)
        same_text = owner[1:] == owner[:-1]
        last = np.zeros(len(word), dtype=bool)
        last[1:] = same_text & (word[1:] == word[:-1])
        add(owner, np.where(last, 0, 1), TRIGRAMS + SHAPES, REPEATS)
        pair = np.flatnonzero(same_text)
        h = mix64(word[pair]) + word[pair + 1]
        add(owner[pair], np.where(_first_seen(owner[pair], h), 3, 2), TRIGRAMS + SHAPES, REPEATS)
    return out


def term_vectors(counts: np.ndarray) -> np.ndarray:
    """Counts as square roots of their share in their field, times the field's weight."""
    out = np.sqrt(counts)
    lo = 0
    for width, weight in zip((TRIGRAMS, SHAPES, REPEATS), WEIGHTS):
        part = out[:, lo : lo + width]
        total = counts[:, lo : lo + width].sum(axis=1, keepdims=True)
        part *= weight / np.sqrt(np.maximum(total, 1))
        lo += width
    return out


@dataclass
class Model:
    """Inverse document frequencies, latent basis, and the labelled documents in the latent space."""

    idf: np.ndarray
    basis: np.ndarray  # terms x dims
    points: np.ndarray  # labelled documents x dims, whole multiples of 1 / GRID as floats
    labels: np.ndarray  # 0 or 1 per labelled document
    votes: np.ndarray  # weight of each labelled document: how many labelled documents it stands for
    prior: float  # share of label 1 among all labelled documents; 0.5 if there are none
    neighbours: int
    power: float

    def latent(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors on the grid; texts without terms stay zero."""
        z = (term_vectors(counts) * self.idf) @ self.basis
        size = np.sqrt((z * z).sum(axis=1, keepdims=True))
        return np.rint(np.divide(z, size, out=np.zeros_like(z), where=size > 1e-12) * GRID)

    def vote(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and highest cosine per row.

        The labelled documents at least as near as the ``neighbours``-th nearest vote.
        """
        n = len(counts)
        score, nearest = np.full(n, self.prior), np.zeros(n)
        if not len(self.labels):
            return score, nearest
        k = min(self.neighbours, len(self.labels))
        cos = self.latent(counts).astype(np.float32) @ self.points.astype(np.float32).T
        edge = np.partition(cos, len(self.labels) - k, axis=1)[:, len(self.labels) - k]
        row, col = np.nonzero((cos >= edge[:, None]) & (cos > 0))
        w = self.votes[col] * (cos[row, col].astype(float) / GRID**2) ** self.power
        total = np.bincount(row, weights=w, minlength=n)
        good = np.bincount(row, weights=w * self.labels[col], minlength=n)
        score = np.divide(good, total, out=score, where=total > 0)
        return np.clip(score, 0, 1), np.clip(cos.max(axis=1) / GRID**2, 0, 1)


def _own(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("_key"), F.col(text).cast("string").alias("_text"))


def _chunks(batch: pa.RecordBatch):
    """Counts of the batch's rows, a bounded number of rows and bytes at a time."""
    for lo, hi in text_batches(batch, "_text", 1 << 20):
        for a in range(lo, hi, BLOCK):
            b = min(hi, a + BLOCK)
            yield a, b, term_counts([t or "" for t in batch.column("_text").slice(a, b - a).to_pylist()])


def document_frequencies(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """In how many documents each term occurs; the last entry is the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]):
        seen = np.zeros(TERMS + 1, dtype=np.int64)
        for batch in batches:
            for a, b, counts in _chunks(batch):
                seen[:-1] += (counts > 0).sum(axis=0)
                seen[-1] += b - a
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[at])], names=["term", "n"])

    parts = _own(docs, key, text).mapInArrow(run, "term int, n long")
    out = np.zeros(TERMS + 1, dtype=np.int64)
    for r in parts.groupBy("term").agg(F.sum("n").alias("n")).collect():  # at most one row per term
        out[r["term"]] = r["n"]
    return out


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    key: str = "doc_id",
    text: str = "text",
    max_labelled: int = 2_000,
    dims: int = 48,
    neighbours: int = 15,
    power: float = 8.0,
) -> Model:
    """Learn from labelled documents.

    Document frequencies come from all of ``docs``.  Of each label (0 or 1;
    others and null are ignored) at most ``max_labelled`` documents are used,
    those with the smallest hashes of their key; each stands for as many labelled
    documents as were left out in its class.  A key with several labels has the one that
    most of its rows give (a tie: 1); a key with several texts has the smallest
    of them.  Labels of keys that ``docs`` does not hold do not count.  Without labels
    every score is 0.5.
    """
    seen = document_frequencies(docs, key=key, text=text)
    idf = np.log(1 + seen[-1] / (1 + seen[:-1]))
    own = _own(docs, key, text).filter("_key is not null")
    y = F.col(label).cast("double")
    per_key = (
        labels.filter(F.col(key).isNotNull() & y.isin(0.0, 1.0))
        .groupBy(F.col(key).cast("long").alias("_key"))
        .agg(F.when(F.avg(y) >= 0.5, 1).otherwise(0).alias("_y"))
    )
    usable = per_key.join(own.select("_key"), "_key", "left_semi")
    number = {r["_y"]: r["n"] for r in usable.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(number.values())
    if not total:
        return Model(idf, np.zeros((TERMS, 0)), np.zeros((0, 0)), np.zeros(0), np.zeros(0), 0.5, neighbours, power)
    chosen = None
    for v in sorted(number):
        part = usable.filter(F.col("_y") == v).orderBy(F.xxhash64(F.lit("quality"), "_key"), "_key").limit(max_labelled)
        chosen = part if chosen is None else chosen.unionByName(part)
    side = docs.sparkSession.createDataFrame(chosen.collect(), "_key long, _y int")  # at most 2 * max_labelled rows
    sample = own.join(F.broadcast(side), "_key").groupBy("_key", "_y").agg(F.min("_text").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for a, b, counts in _chunks(batch):
                at = [np.flatnonzero(c) for c in counts]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_key").slice(a, b - a), batch.column("_y").slice(a, b - a),
                        pa.array([i.astype("<u2").tobytes() for i in at], pa.binary()),
                        pa.array([c[i].astype("<u4").tobytes() for c, i in zip(counts, at)], pa.binary()),
                    ],
                    names=["_key", "_y", "at", "n"],
                )

    # At most 2 * max_labelled rows of at most TERMS entries reach the driver.
    rows = sample.mapInArrow(run, "_key long, _y int, at binary, n binary").collect()
    rows.sort(key=lambda r: r["_key"])
    x = np.zeros((len(rows), TERMS), dtype=np.float32)
    for i, r in enumerate(rows):
        c = np.zeros((1, TERMS))
        c[0, np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["n"], "<u4")
        x[i] = term_vectors(c)[0] * idf
    labels_ = np.array([r["_y"] for r in rows], dtype=float)
    used = {v: max(1, int((labels_ == v).sum())) for v in (0, 1)}
    votes = np.array([number[int(v)] / used[int(v)] for v in labels_])
    model = Model(idf, _basis(x, dims), np.zeros((0, 0)), labels_, votes, number.get(1, 0) / total, neighbours, power)
    model.points = np.concatenate(
        [
            model.latent(_dense(rows[i : i + BLOCK]))
            for i in range(0, len(rows), BLOCK)
        ]
    )
    return model


def _dense(rows: list) -> np.ndarray:
    out = np.zeros((len(rows), TERMS))
    for c, r in zip(out, rows):
        c[np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["n"], "<u4")
    return out


def _basis(x: np.ndarray, dims: int, rounds: int = 6) -> np.ndarray:
    """The leading right singular vectors of ``x``, by subspace iteration from a fixed start."""
    dims = min(dims, *x.shape)
    wide = min(dims + 16, *x.shape)
    q = np.random.default_rng(0).normal(size=(x.shape[1], wide)).astype(x.dtype)
    for _ in range(rounds):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd((x @ q).astype(float), full_matrices=False)
    return q.astype(float) @ vt[:dims].T


def scores(
    docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text", threshold: float = 0.3
) -> DataFrame:
    """``key, score, predicted, nearest`` of every whole text.

    ``score`` (0 to 1) is the weighted share of label 1 among the nearest labelled
    documents' votes, ``predicted`` 1 from ``threshold`` on, ``nearest`` the highest
    cosine.  A text that shares no term with a labelled document, null and
    empty texts among them, gets the share of label 1 among all labels.
    Rows are judged one by one: repeated rows get repeated results, rows
    without a key too; other columns are ignored.  No shuffle.  The model
    that goes to every task is bounded by the fit's parameters.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]):
        m = shared.value
        for batch in batches:
            for a, b, counts in _chunks(batch):
                score, nearest = m.vote(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_key").slice(a, b - a), pa.array(score),
                        pa.array((score >= threshold).astype(np.int32)), pa.array(nearest.astype(float)),
                    ],
                    names=[key, "score", "predicted", "nearest"],
                )

    return _own(docs, key, text).mapInArrow(run, f"{key} long, score double, predicted int, nearest double")
