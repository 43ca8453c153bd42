"""Packing documents into fixed windows: length combinations chosen by non-negative least squares.

Every document is cut into full windows and a remainder.  Remainders are
counted per length class; the shallow combinations of classes (two or three)
that fill a window exactly are listed, and non-negative least squares finds
how often each is to be used so that the uses match the class counts.  Repeat
counts are rounded down and handed out to documents by their rank in their
class.  What is left over is packed greedily: pieces in a row, cut where a
window ends.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smogmesh.llm.common import kept, text_batches, written
from smogmesh.llm.units import Store, Units, after_letter, joined

#: Units kept per worker process.
STORE_SIZE = 600_000
_SPACES = np.array([9, 10, 11, 12, 13, 32], dtype=np.uint8)
_MARKS = np.array([b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"], dtype=np.uint8)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# -- token ids --------------------------------------------------------------------


class Encoder:
    """Ids of whole texts by the tokenizer's library, each distinct unit encoded once.

    The tokenizer drops white space and splits words from punctuation, so the
    ids of a text are those of its units: the stretches between white space,
    cut again between a letter and an ASCII mark (not the apostrophe, which
    opens contractions).  Texts that may hold a special token's string are
    given to the library whole.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(tokenizer_file)
        self.store = Store(STORE_SIZE)

    def _make(self, units: list[bytes]) -> list[bytes]:
        texts = [u.decode("utf-8", "replace") for u in units]
        out = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in out]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        special = [i for i, t in enumerate(texts) if "<|" in t]
        data, bounds = joined(["" if "<|" in t else t for t in texts])
        if len(data):
            data = _LOWER[data]
            space = np.isin(data, _SPACES)
            cut = np.zeros(len(data), dtype=bool)
            cut[1:] = space[:-1] & ~space[1:]
            cut |= np.isin(data, _MARKS) & after_letter(data)
            u = Units(data, cut, bounds, lambda keys: self.store.get(keys, self._make), "<u4")
            ids = u.spread()
            out = [ids[a:b] for a, b in zip(u.text_ends[:-1], u.text_ends[1:])]
        else:
            out = [np.zeros(0, dtype="<u4") for _ in texts]
        for i in special:
            out[i] = np.array(self.tok.encode(texts[i], add_special_tokens=False).ids, dtype="<u4")
        return out


def encoder(tokenizer_file: str) -> Encoder:
    encoders = kept("packing")
    if tokenizer_file not in encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        encoders[tokenizer_file] = Encoder(tokenizer_file)
    return encoders[tokenizer_file]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def encoded(docs: DataFrame, tokenizer_file: str, *, window: int, end_id: int) -> DataFrame:
    """Per row of ``docs``: ``row, doc_id, doc_tokens, full_crc array, rest, rest_crc, rest_ids``.

    ``row`` is unique.  The document's ids with ``end_id`` behind are cut into
    full windows, of which only the checksums are kept, and a remainder of
    ``rest`` ids (below ``window``), kept as 32-bit little-endian numbers.
    """
    schema = pa.schema(
        [
            ("row", pa.int64()), ("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("full_crc", pa.list_(pa.int64())),
            ("rest", pa.int32()), ("rest_crc", pa.int64()), ("rest_ids", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]):
        enc = encoder(tokenizer_file)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            for lo, hi in text_batches(batch, "_text", 8 << 20):
                texts = [t or "" for t in batch.column("_text").slice(lo, hi - lo).to_pylist()]
                cols: list[list] = [[], [], [], [], []]
                for ids in enc.ids(texts):
                    ids = np.concatenate([ids, end])
                    cut = len(ids) - len(ids) % window
                    rest = ids[cut:].astype("<u4")
                    row = (len(ids), [_crc(ids[i : i + window]) for i in range(0, cut, window)], len(rest), _crc(rest), rest.tobytes())
                    for c, v in zip(cols, row):
                        c.append(v)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row").slice(lo, hi - lo), batch.column("_key").slice(lo, hi - lo)]
                    + [pa.array(c, f.type) for c, f in zip(cols, list(schema)[2:])],
                    schema=schema,
                )

    own = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("doc_id").cast("long").alias("_key"),
        F.col("text").cast("string").alias("_text"),
    )
    return own.mapInArrow(
        run,
        "row long, doc_id long, doc_tokens long, full_crc array<long>, rest int, rest_crc long, rest_ids binary",
    )


# -- combinations and repeat counts ----------------------------------------------------


def combinations(units: int, depth: int = 3) -> list[tuple[int, ...]]:
    """Class tuples (descending) of at most ``depth`` classes below ``units`` that sum to ``units``."""
    out = [(a, units - a) for a in range(units - 1, (units - 1) // 2, -1) if a >= units - a]
    if depth >= 3:
        for a in range(units - 2, 0, -1):
            for b in range(min(a, units - a - 1), 0, -1):
                c = units - a - b
                if 1 <= c <= b:
                    out.append((a, b, c))
    return out


def nnls(columns: np.ndarray, target: np.ndarray, *, rounds: int = 0) -> np.ndarray:
    """x >= 0 minimising ``|columns @ x - target|`` (Lawson-Hanson active sets)."""
    n = columns.shape[1]
    rounds = rounds or 3 * columns.shape[0]
    x = np.zeros(n)
    active: list[int] = []
    for _ in range(rounds):
        w = columns.T @ (target - columns @ x)
        w[active] = -np.inf
        j = int(np.argmax(w))
        if w[j] <= 1e-9 * max(1.0, float(np.abs(target).max(initial=0.0))):
            break
        active.append(j)
        while True:
            s, *_ = np.linalg.lstsq(columns[:, active], target, rcond=None)
            if (s > 0).all():
                x[:] = 0.0
                x[active] = s
                break
            old = x[active]
            neg = s <= 0
            step = float((old[neg] / (old[neg] - s[neg])).min())
            x[active] = old + step * (s - old)
            active = [k for k in active if x[k] > 1e-12]
            x[[k for k in range(n) if k not in set(active)]] = 0.0
            if not active:
                break
    return x


@dataclass
class Plan:
    """Which ranks of each class go to which combination: small arrays, sized by classes alone.

    Uses of class ``c`` cover the ranks from ``first[k]`` on, for the uses k of
    that class in order: ``per[k]`` pieces to each of ``repeat[k]`` sequences,
    which are numbered from ``sequence[k]`` on, in slots from ``slot[k]`` on.
    """

    by_class: dict[int, np.ndarray]
    planned: dict[int, int]
    n_sequences: int


def plan_uses(histogram: dict[int, int], units: int, depth: int = 3) -> Plan:
    """Solve the repeat counts for the class counts ``histogram`` and round them down.

    Rounded counts never ask for more pieces of a class than it has: where the
    fit would, the combination's count is lowered, the largest first.
    """
    combos = [c for c in combinations(units, depth) if all(histogram.get(u, 0) for u in c)]
    have = np.zeros(units + 1)
    for u, n in histogram.items():
        have[u] = n
    uses: dict[int, list] = {}
    taken: dict[int, int] = {}
    sequence = 0
    if combos:
        a = np.zeros((units + 1, len(combos)))
        for j, c in enumerate(combos):
            for u in c:
                a[u, j] += 1
        x = np.floor(nnls(a, have) + 1e-9).astype(np.int64)
        left = have.astype(np.int64)
        for j in np.argsort(-x, kind="stable"):
            if x[j] <= 0:
                break
            need = {u: combos[j].count(u) for u in combos[j]}
            k = int(min(x[j], *(left[u] // m for u, m in need.items())))
            if k <= 0:
                continue
            slot = 0
            for u, m in need.items():
                uses.setdefault(u, []).append((taken.get(u, 0), m, k, sequence, slot))
                taken[u] = taken.get(u, 0) + m * k
                left[u] -= m * k
                slot += m
            sequence += k
    return Plan({u: np.array(v, dtype=np.int64) for u, v in uses.items()}, taken, sequence)


# -- ranks and windows ---------------------------------------------------------------------


def _ranked(rows: DataFrame, group: str, order: str, n_rows: int, chunk: int = 20_000) -> DataFrame:
    """Add ``rank`` from 0 within ``group``, numbered in parallel.

    Rows are dealt into about ``n_rows / chunk`` buckets by hash; a group's
    rank is the count in the buckets before plus the place within the bucket,
    so one huge group is spread over all buckets.
    """
    buckets = max(1, n_rows // chunk)
    dealt = rows.withColumn("_b", F.pmod(F.xxhash64(order), F.lit(buckets)))
    counts = written(dealt.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n")), "rank-counts")
    w = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(group, "_b", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_base"))
    place = F.row_number().over(Window.partitionBy(group, "_b").orderBy(order)) - 1
    return (
        dealt.withColumn("_place", place)
        .join(base, [group, "_b"])
        .withColumn("rank", F.col("_base") + F.col("_place"))
        .drop("_b", "_base", "_place")
    )


def _assigned(plan: Plan) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            cls = batch.column("cls").to_numpy()
            rank = batch.column("rank").to_numpy()
            seq = np.full(len(cls), -1, dtype=np.int64)
            slot = np.zeros(len(cls), dtype=np.int64)
            for c in np.unique(cls):
                use = plan.by_class.get(int(c))
                if use is None:
                    continue
                at = np.flatnonzero((cls == c) & (rank < plan.planned[int(c)]))
                u = use[np.searchsorted(use[:, 0], rank[at], side="right") - 1]
                inside = rank[at] - u[:, 0]
                seq[at] = u[:, 3] + inside // u[:, 1]
                slot[at] = u[:, 4] + inside % u[:, 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("cls"), batch.column("rest"), batch.column("rank"), pa.array(seq), pa.array(slot)],
                names=["row", "cls", "rest", "rank", "seq", "slot"],
            )

    return run


def _greedy(left: DataFrame, window: int, first: int, n_left: int, chunk: int = 20_000) -> DataFrame:
    """Left-over pieces in a row, cut where a window ends: ``row, from, length, sequence_id, offset``.

    The row runs within buckets of about ``chunk`` pieces, so that buckets are
    packed in parallel; only a bucket's last window may stay short.
    """
    buckets = max(1, n_left // chunk)
    dealt = left.withColumn("_b", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    w = Window.partitionBy("_b").orderBy(F.col("rest").desc(), "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_at", F.coalesce(F.sum(F.col("rest").cast("long")).over(w), F.lit(0)))
    sums = written(dealt.groupBy("_b").agg(F.sum(F.col("rest").cast("long")).alias("_n")), "pack-buckets")
    # One row per bucket; the windows used by the buckets before.
    sizes = sums.select("_b", F.ceil(F.col("_n") / window).alias("_w"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("_b", F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_base"))
    end = F.col("_at") + F.col("rest")
    span = F.sequence(F.floor(F.col("_at") / window), F.floor((end - 1) / window))
    cut = placed.join(base, "_b").withColumn("_k", F.explode(span))
    lo = F.greatest(F.col("_at"), F.col("_k") * window)
    hi = F.least(end, (F.col("_k") + 1) * window)
    return cut.select(
        "row",
        (lo - F.col("_at")).cast("int").alias("from"),
        (hi - lo).cast("int").alias("length"),
        (F.lit(first) + F.col("_base") + F.col("_k")).alias("sequence_id"),
        (lo - F.col("_k") * window).alias("offset"),
    )


def pack(
    docs: DataFrame, tokenizer_file: str, *, window: int = 2048, unit: int = 8, depth: int = 3, end_id: int = 1
) -> DataFrame:
    """Pack all rows of ``docs`` into sequences of at most ``window`` tokens.

    Returns one row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``.  A document's tokens are its ids and ``end_id``.
    Remainders fall into classes of ``unit`` tokens, rounded up, so a planned
    sequence is short by less than ``unit`` tokens per piece.  Null texts count
    as empty (one token); repeated rows are packed each on its own; an empty
    table gives no rows; columns other than doc_id and text are ignored.

    The class counts (``window / unit`` numbers) and the plan made of them are
    all that the driver sees.
    """
    if window % unit:
        raise ValueError("window must be a multiple of unit")
    enc = written(encoded(docs, tokenizer_file, window=window, end_id=end_id), "pack-ids")
    rests = enc.filter("rest > 0").select(
        "row", "rest", F.ceil(F.col("rest") / unit).cast("int").alias("cls")
    )
    histogram = {r["cls"]: r["n"] for r in rests.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_uses(histogram, window // unit, depth)
    ranked = _ranked(rests, "cls", "row", sum(histogram.values()))
    placed = written(
        ranked.select("row", "cls", "rest", F.col("rank").cast("long").alias("rank")).mapInArrow(
            _assigned(plan), "row long, cls int, rest int, rank long, seq long, slot long"
        ),
        "pack-placed",
    )
    # Planned sequences hold at most `depth` pieces each.
    inner = Window.partitionBy("seq").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    planned = placed.filter("seq >= 0").select(
        "row",
        F.lit(0).alias("from"),
        F.col("rest").alias("length"),
        F.col("seq").alias("sequence_id"),
        F.coalesce(F.sum(F.col("rest").cast("long")).over(inner), F.lit(0)).alias("offset"),
    )
    n_left = sum(histogram.values()) - sum(plan.planned.values())
    greedy = written(
        _greedy(placed.filter("seq < 0").select("row", "rest"), window, plan.n_sequences, n_left), "pack-greedy"
    )
    last = greedy.agg(F.max("sequence_id")).first()[0]
    first_full = plan.n_sequences if last is None else last + 1
    lens = enc.select("row", "doc_id", "doc_tokens", "rest", "rest_crc")
    start = (F.col("doc_tokens") - F.col("rest") + F.col("from")).alias("start")
    # Only remainders that a window's end cuts need their ids again.
    whole = planned.unionByName(greedy).join(lens, "row")
    uncut = whole.filter("length = rest").select(
        "doc_id", start, F.col("length").cast("long").alias("length"), F.col("rest_crc").alias("ids_crc32"),
        "doc_tokens", "sequence_id", F.col("offset").cast("long").alias("offset"),
    )
    halves = greedy.join(enc.select("row", "rest", "rest_ids", "doc_id", "doc_tokens"), "row").filter("length < rest")
    part = F.expr("substring(rest_ids, `from` * 4 + 1, length * 4)")
    cut = halves.select(
        "doc_id", start, F.col("length").cast("long").alias("length"), F.crc32(part).alias("ids_crc32"),
        "doc_tokens", "sequence_id", F.col("offset").cast("long").alias("offset"),
    )
    # Full windows: numbered by an ordinal per row that needs no order over all rows.
    fulls = enc.filter(F.size("full_crc") > 0).select("row", "doc_id", "doc_tokens", "full_crc", F.size("full_crc").alias("n"))
    full = _full_windows(fulls, window, first_full)
    return uncut.unionByName(cut).unionByName(full)


def _full_windows(fulls: DataFrame, window: int, first: int, chunk: int = 20_000) -> DataFrame:
    """One sequence per full window, numbered from ``first`` on without gaps."""
    small = fulls.select("row", "n")
    n = small.count()
    buckets = max(1, n // chunk)
    dealt = fulls.withColumn("_b", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    sums = written(dealt.groupBy("_b").agg(F.sum("n").alias("_n")), "pack-full")
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    w = Window.partitionBy("_b").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    at = F.lit(first) + F.col("_base") + F.coalesce(F.sum("n").over(w), F.lit(0))
    return (
        dealt.join(base, "_b")
        .withColumn("_at", at)
        .select("doc_id", "doc_tokens", "_at", F.posexplode("full_crc").alias("_k", "ids_crc32"))
        .select(
            "doc_id",
            (F.col("_k").cast("long") * window).alias("start"),
            F.lit(window).cast("long").alias("length"),
            "ids_crc32",
            "doc_tokens",
            (F.col("_at") + F.col("_k")).alias("sequence_id"),
            F.lit(0).cast("long").alias("offset"),
        )
    )
