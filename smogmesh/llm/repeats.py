"""Exact removal of repeated byte strings, by column-wise suffix arrays of documents.

A byte goes if a string of ``length`` bytes that covers it also starts
earlier in the collection.  Equal strings hold the same smallest ``gram``-byte
anchor (by hash), so the collection is cut at anchors: a *run* is a stretch of
a text whose strings all have the same anchor.  Runs that are equal as a whole
repeat entirely, except for the first.  The first occurrences of different
runs with the same anchor may still share strings; they are built into a
suffix array of their collection, one symbol per run each round: from the
last symbol to the first, each round extends the transform and the common
prefixes by one column, reading and writing both in sequence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogmesh.llm.common import byte_codes, mix64, prefix_sums, shuffle_partitions, signed, span_hash, text_batches, written

LENGTH, GRAM = 100, 24


# -- cutting texts at anchors ------------------------------------------------------------


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum over each ``width`` neighbours, by doubling."""
    have, m = 1, x
    while 2 * have <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    if have < width:
        m = np.minimum(m[: len(m) - (width - have)], m[width - have :])
    return m


def runs_of(rows: list[bytes], length: int, gram: int):
    """Runs of all texts: (row, start, strings, anchor hash, hash of the run, hashes of its two sides).

    A run covers ``strings`` neighbouring strings of ``length`` bytes that
    share the anchor at the same place of the text.  A string reaches over at
    least half of what it has beside the anchor to the left or to the right;
    the sides are those halves of the text, 0 where no string of the run
    reaches over them.  Two runs that share a string have an equal side.
    """
    data = np.frombuffer(b"".join(rows), dtype=np.uint8)
    size = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
    end = np.cumsum(size)
    empty = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return (empty,) * 7
    s = prefix_sums(data, byte_codes())
    at = np.arange(len(data) - gram + 1)
    h = span_hash(s, at, at + gram)
    bits = np.uint64(max(1, len(data)).bit_length())
    # High bits of the hash, then the place: ties go to the leftmost, for equal strings alike.
    mark = (h >> bits << bits) | at.astype(np.uint64)
    low = _sliding_min(mark, length - gram + 1)
    place = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), size)[: len(place)]
    inside = np.arange(len(place)) + length <= end[row]
    new = inside.copy()
    new[1:] &= (place[1:] != place[:-1]) | (row[1:] != row[:-1]) | ~inside[:-1]
    start = np.flatnonzero(new)
    total = np.cumsum(inside)
    strings = np.diff(np.append(total[start] - 1, total[-1] if len(total) else 0))
    whole = mix64(span_hash(s, start, start + strings + length - 1) + (place[start] - start).astype(np.uint64))
    p, half = place[start], (length - gram) // 2
    left, right = p - start >= half, p - (start + strings - 1) <= length - gram - half
    side_l, side_r = np.zeros(len(p), dtype=np.uint64), np.zeros(len(p), dtype=np.uint64)
    side_l[left] = span_hash(s, p[left] - half, p[left])
    side_r[right] = span_hash(s, p[right] + gram, p[right] + gram + half)
    sides = [x.astype(np.uint32).astype(np.int64) for x in (side_l, side_r)]
    return row[start], start - (end - size)[row[start]], strings, signed(h[p]), signed(whole), *sides


def _bytes(batch: pa.RecordBatch, lo: int, hi: int) -> list[bytes]:
    return [v or b"" for v in batch.column("_text").slice(lo, hi - lo).cast(pa.binary()).to_pylist()]


def _run_table(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """``anchor, whole, id, start, strings, again``: the runs of all texts.

    Of runs that are equal within one batch of texts only the first (by id and
    start) keeps its anchor; the others are known to repeat (``again``) and go
    to no anchor, so frequent passages reach an anchor once per batch.
    """
    schema = pa.schema(
        [
            ("anchor", pa.int64()), ("whole", pa.int64()), ("sides", pa.int64()), ("id", pa.int64()), ("start", pa.int32()),
            ("strings", pa.int16()), ("again", pa.bool_()),
        ]
    )

    def runs(batch: pa.RecordBatch, lo: int, hi: int):
        # Small pieces for the arrays of all bytes, joined for the comparison of runs.
        parts = []
        part = batch.slice(lo, hi - lo)
        for a, b in text_batches(part, "_text", 1 << 18):
            found = runs_of(_bytes(part, a, b), length, gram)
            parts.append((found[0] + a, *found[1:]))
        return [np.concatenate(x) for x in zip(*parts)]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ids = batch.column("_id").to_numpy()
            for lo, hi in text_batches(batch, "_text", 8 << 20):
                row, *columns = runs(batch, lo, hi)
                own = ids[lo:hi][row]
                order = np.lexsort((columns[0], own, columns[2], columns[3]))
                own, start, strings, anchor, whole, left, right = (x[order] for x in (own, *columns))
                again = np.zeros(len(own), dtype=bool)
                again[1:] = (whole[1:] == whole[:-1]) & (anchor[1:] == anchor[:-1])
                # What is known to repeat needs no anchor; any number spreads it.
                spread = np.where(again, signed(mix64(own.astype(np.uint64) + start.astype(np.uint64))), anchor)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(spread), pa.array(whole), pa.array(left << 32 | right), pa.array(own),
                        pa.array(start.astype(np.int32)), pa.array(strings.astype(np.int16)), pa.array(again),
                    ],
                    schema=schema,
                )

    return rows.mapInArrow(run, "anchor long, whole long, sides long, id long, start int, strings short, again boolean")


def _fates(c: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(again, shared) masks of complete anchors' runs, sorted by anchor, again, content and place."""
    new = np.ones(len(c["anchor"]), dtype=bool)
    new[1:] = c["anchor"][1:] != c["anchor"][:-1]
    first = new.copy()
    first[1:] |= c["whole"][1:] != c["whole"][:-1]
    again = c["again"] | ~first
    group = np.cumsum(new) - 1
    contents = np.bincount(group, weights=~again)
    shared = ~again & (contents[group] > 1)
    # Of an anchor's contents, only those that have a side in common with another one.
    at = np.flatnonzero(shared)
    twin = np.zeros(len(at), dtype=bool)
    for side in (c["sides"][at] >> 32, c["sides"][at] & 0xFFFFFFFF):
        order = np.lexsort((side, group[at]))
        g, v = group[at][order], side[order]
        same = (g[1:] == g[:-1]) & (v[1:] == v[:-1]) & (v[1:] != 0)
        twin[order[1:][same]] = True
        twin[order[:-1][same]] = True
    shared[at[~twin]] = False
    return again, shared


def _resolved(runs: DataFrame) -> DataFrame:
    """``anchor, id, start, strings, again``: runs that repeat, and first ones that share their anchor."""
    n = shuffle_partitions(runs.sparkSession)
    dealt = runs.repartition(n, "anchor").sortWithinPartitions("anchor", "again", "whole", "id", "start")
    schema = pa.schema(
        [("anchor", pa.int64()), ("id", pa.int64()), ("start", pa.int32()), ("strings", pa.int16()), ("again", pa.bool_())]
    )

    def done(c: dict[str, np.ndarray]) -> pa.RecordBatch:
        again, shared = _fates(c)
        keep = again | shared
        arrays = [pa.array(c[f.name][keep], f.type) for f in list(schema)[:4]]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(again[keep])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]):
        rest = None  # runs of the last anchor, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            c = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in batch.schema.names}
            if rest is not None:
                c = {k: np.concatenate([rest[k], c[k]]) for k in c}
            cut = int(np.searchsorted(c["anchor"], c["anchor"][-1], side="left"))
            rest = {k: v[cut:] for k, v in c.items()}
            if cut:
                yield done({k: v[:cut] for k, v in c.items()})
        if rest is not None:
            yield done(rest)

    return dealt.mapInArrow(run, "anchor long, id long, start int, strings short, again boolean")


# -- column-wise suffix array of a collection ---------------------------------------------


def column_suffix_array(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row number, suffix length, common prefix with the suffix before) in suffix order.

    Starts with every row's empty suffix and inserts one symbol per row each
    round, from the rows' ends to their starts.  Each round reads the
    transform, the common prefixes and the owners once, front to back, and
    writes their next version; what precedes a suffix that was inserted last
    is open (0) until the next round gives it.
    """
    m = len(rows)
    size = np.fromiter(map(len, rows), dtype=np.int64, count=m)
    data = np.frombuffer(b"".join(rows), dtype=np.uint8)
    used = np.bincount(data, minlength=256) > 0
    # Symbols numbered from 1 in their order: one byte each, unless all 256 occur.
    number = np.cumsum(used).astype(np.uint8 if used.sum() < 256 else np.uint16)
    data = number[data]
    end = np.cumsum(size)
    small = np.uint8 if size.max(initial=0) < 255 else np.int32
    bwt = np.zeros(m, dtype=data.dtype)
    lcp = np.zeros(m, dtype=small)
    owner = np.arange(m, dtype=np.int32)
    age = np.zeros(m, dtype=small)
    at = np.arange(m)  # place of the suffix that each row inserted last
    # For each suffix c + T, in order: the symbol c and the place of T; both rise together.
    keys = np.zeros(0, dtype=np.int64)
    low = np.int64((1 << 32) - 1)
    for depth in range(1, int(size.max(initial=0)) + 1):
        grow = np.flatnonzero(size >= depth)
        symbol = data[end[grow] - depth]
        bwt[at[grow]] = symbol
        fresh = symbol.astype(np.int64) << 32 | at[grow]
        order = np.argsort(fresh)
        fresh, grow = fresh[order], grow[order]
        into = np.searchsorted(keys, fresh)
        n_old, n_new = len(keys), len(fresh)
        k = into + np.arange(n_new)
        shift = np.repeat(np.arange(n_new + 1), np.diff(np.concatenate([[0], into, [n_old]])))
        moved = np.arange(n_old) + shift  # where the suffixes known before go, in the same order

        def merged(values: np.ndarray, fill) -> np.ndarray:
            out = np.empty(m + n_old + n_new, dtype=values.dtype)
            out[:m] = values[:m]
            body = out[m:]
            body[moved] = values[m:]
            body[k] = fill
            return out

        both = np.empty(n_old + n_new, dtype=np.int64)
        both[moved] = keys
        both[k] = fresh
        tails = both & low
        # Common prefixes change only beside new suffixes: one more than the least between the tails.
        beside = np.zeros(len(both) + 1, dtype=bool)
        beside[k] = beside[k + 1] = True
        touched = np.flatnonzero(beside[:-1])
        inner = touched[touched > 0]
        same = inner[both[inner] >> 32 == both[inner - 1] >> 32]
        next_lcp = merged(lcp, 0)
        next_lcp[m + touched] = 0
        if len(same):
            lo, hi = tails[same - 1] + 1, tails[same] + 1
            order = np.argsort(lo)
            spans = np.empty(2 * len(lo), dtype=np.int64)
            spans[::2], spans[1::2] = lo[order], hi[order]
            least = np.minimum.reduceat(np.append(lcp, small(0)), spans)[::2]
            next_lcp[m + same[order]] = least + 1
        keys = both + np.concatenate([np.zeros(m, dtype=np.int64), shift])[tails]
        bwt, lcp, owner, age = merged(bwt, 0), next_lcp, merged(owner, grow), merged(age, depth)
        at[grow] = m + k
    return owner[m:], age[m:], lcp[m:]


def later_strings(rows: list[bytes], ids: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(id, start) of the rows' strings of ``length`` bytes that start earlier somewhere else in the rows."""
    owner, age, lcp = column_suffix_array(rows)
    size = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
    group = np.cumsum(lcp < length)
    long = age >= length
    owner, group = owner[long], group[long]
    start = starts[owner] + size[owner] - age[long]
    order = np.lexsort((start, ids[owner], group))
    group, start, own = group[order], start[order], ids[owner][order]
    later = np.zeros(len(group), dtype=bool)
    later[1:] = group[1:] == group[:-1]
    return own[later], start[later]


def _stretches(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbouring string starts of one text as (id, first start, number)."""
    order = np.lexsort((starts, ids))
    ids, starts = ids[order], starts[order]
    new = np.ones(len(ids), dtype=bool)
    new[1:] = (ids[1:] != ids[:-1]) | (starts[1:] > starts[:-1] + 1)
    first = np.flatnonzero(new)
    return ids[first], starts[first], np.diff(np.append(first, len(ids)))


_SPANS = pa.schema([("id", pa.int64()), ("start", pa.int32()), ("strings", pa.int32())])


def _shared_repeats(pieces: DataFrame, length: int, chunk: int = 1 << 18) -> DataFrame:
    """``id, start, strings`` of the strings that repeat among first runs of one anchor.

    Whole anchors are gathered up to ``chunk`` bytes and built as one collection.
    """
    n = shuffle_partitions(pieces.sparkSession)
    dealt = pieces.repartition(n, "anchor").sortWithinPartitions("anchor")

    def built(ids: list, starts: list, rows: list) -> pa.RecordBatch:
        own, at = later_strings(rows, np.array(ids, dtype=np.int64), np.array(starts, dtype=np.int64), length)
        i, s, k = _stretches(own, at)
        return pa.RecordBatch.from_arrays([pa.array(i), pa.array(s.astype(np.int32)), pa.array(k.astype(np.int32))], schema=_SPANS)

    def run(batches: Iterator[pa.RecordBatch]):
        ids, starts, rows, size, last = [], [], [], 0, None
        for batch in batches:
            for a, i, s, b in zip(*(batch.column(c).to_pylist() for c in ("anchor", "id", "start", "bytes"))):
                if a != last and size >= chunk:
                    yield built(ids, starts, rows)
                    ids, starts, rows, size = [], [], [], 0
                ids.append(i)
                starts.append(s)
                rows.append(b)
                size += len(b)
                last = a
        if rows:
            yield built(ids, starts, rows)

    return dealt.mapInArrow(run, "id long, start int, strings int")


def _pieces(rows: DataFrame, length: int) -> DataFrame:
    """``anchor, id, start, bytes`` of the runs listed in ``_runs``, cut from their texts."""
    schema = pa.schema([("anchor", pa.int64()), ("id", pa.int64()), ("start", pa.int32()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                out: list[list] = [[], [], [], []]
                for i, text, runs in zip(part.column("_id").to_pylist(), _bytes(part, 0, part.num_rows), part.column("_runs").to_pylist()):
                    for r in runs:
                        s = r["start"]
                        for c, v in zip(out, (r["anchor"], i, s, text[s : s + r["strings"] + length - 1])):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)

    return rows.mapInArrow(run, "anchor long, id long, start int, bytes binary")


def _crowded_repeats(pieces: DataFrame, length: int) -> DataFrame:
    """``id, start, strings``, as ``_shared_repeats``, for anchors with too many runs for one task.

    Every string goes its own way by two 64-bit hashes; the first one of each
    is a partial aggregate.
    """
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("id", pa.int64()), ("start", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]):
        codes = byte_codes()
        for batch in batches:
            for i, s, b in zip(*(batch.column(c).to_pylist() for c in ("id", "start", "bytes"))):
                data = np.frombuffer(b, dtype=np.uint8)
                at = np.arange(len(data) - length + 1)
                h = [signed(span_hash(prefix_sums(data, c), at, at + length)) for c in (codes, mix64(codes))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[0]), pa.array(h[1]), pa.array(np.full(len(at), i)), pa.array((at + s).astype(np.int32))], schema=schema
                )

    strings = written(pieces.mapInArrow(run, "h1 long, h2 long, id long, start int"), "repeats-crowded")
    first = strings.groupBy("h1", "h2").agg(F.min(F.struct("id", "start")).alias("f"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    first = written(first.select("h1", "h2", F.col("f.id").alias("fid"), F.col("f.start").alias("fs")), "repeats-crowded")
    later = strings.join(first, ["h1", "h2"]).filter("id <> fid or start <> fs")
    return later.select("id", "start", F.lit(1).alias("strings"))


# -- the operator -----------------------------------------------------------------------------


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``_id, _key, _text``: ``_id`` is unique and in the order of the keys.

    It is the key itself, unless keys are null or repeat: then rows of one key
    are numbered in the order of their texts, and nulls come first.
    """
    rows = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).cast("string").alias("_text"))
    per = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("n"))
    seen = per.agg(F.max("n").alias("n"), F.min("_key").alias("lo"), F.count_if(F.col("_key").isNull()).alias("nulls")).first()
    if (seen["n"] or 1) == 1 and not seen["nulls"]:
        return rows.withColumn("_id", F.col("_key"))
    from pyspark.sql import Window

    copy = F.row_number().over(Window.partitionBy("_key").orderBy("_text")) - 1
    order = F.coalesce(F.col("_key"), F.lit((seen["lo"] or 0) - 1))
    return written(rows.withColumn("_id", order * seen["n"] + copy), "repeats-keyed")


def repeated_spans(rows: DataFrame, *, length: int = LENGTH, gram: int = GRAM, crowd: int = 20_000) -> DataFrame:
    """``id, start, strings``: the strings of ``rows`` (``_id, _text``) that also start earlier."""
    found = written(_resolved(_run_table(rows.select("_id", "_text"), length, gram)), "repeats-runs")
    again = found.filter("again").select("id", "start", F.col("strings").cast("int").alias("strings"))
    shared = found.filter("not again").select("anchor", "id", "start", "strings")
    crowded = written(
        shared.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd).select("anchor"), "repeats-crowds"
    )

    def cut(runs: DataFrame) -> DataFrame:
        # A text's own runs: no more than the text has bytes.
        per = runs.groupBy(F.col("id").alias("_id")).agg(F.collect_list(F.struct("anchor", "start", "strings")).alias("_runs"))
        return _pieces(rows.select("_id", "_text").join(per, "_id"), length)

    if crowded.isEmpty():
        return again.unionByName(_shared_repeats(cut(shared), length))
    few = cut(shared.join(crowded, "anchor", "left_anti"))
    many = cut(shared.join(crowded, "anchor", "left_semi"))
    return again.unionByName(_shared_repeats(few, length)).unionByName(_crowded_repeats(many, length))


def remove_repeats(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH, with_text: bool = False
) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256`` of every row, and ``kept`` (binary) if wanted.

    Every byte is removed that a string of ``length`` bytes covers which also
    starts earlier: in a smaller key, or in the same text before.  Strings are
    those of the input.  Null texts count as empty; of rows that repeat a key,
    those with the smaller text come first; rows with a null key come before all
    others; an empty table gives an empty result; other columns are ignored.
    """
    rows = _keyed(docs, key, text)
    spans = written(repeated_spans(rows, length=length), "repeats-spans")
    per = spans.groupBy(F.col("id").alias("_id")).agg(F.collect_list(F.struct("start", "strings")).alias("_spans"))
    both = rows.join(per, "_id", "left").select("_key", "_text", "_spans")
    fields = [(key, pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    schema = pa.schema(fields + [("kept", pa.binary())] * with_text)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for lo, hi in text_batches(batch, "_text", 8 << 20):
                keys = batch.column("_key").slice(lo, hi - lo).to_pylist()
                spans = batch.column("_spans").slice(lo, hi - lo)
                out: list[list] = [[] for _ in schema]
                for j, (k, b) in enumerate(zip(keys, _bytes(batch, lo, hi))):
                    kept, n_spans = b, 0
                    own = spans[j]
                    if own.is_valid:
                        v = own.values
                        start = v.field("start").to_numpy().astype(np.int64)
                        count = v.field("strings").to_numpy().astype(np.int64)
                        edge = np.zeros(len(b) + 1, dtype=np.int64)
                        np.add.at(edge, start, 1)
                        np.add.at(edge, start + count + length - 1, -1)
                        gone = np.cumsum(edge)[:-1] > 0
                        n_spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
                    row = (k, len(b), len(b) - len(kept), n_spans, hashlib.sha256(kept).hexdigest(), kept)
                    for c, x in zip(out, row):
                        c.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, schema)], schema=schema)

    ddl = f"{key} long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return both.mapInArrow(run, ddl)
