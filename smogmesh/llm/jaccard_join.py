"""Exact Jaccard self-join of word-shingle sets as a metric-space join.

The Jaccard distance is a metric.  Almost all pairs of documents lie at its
maximum, so pivots drawn from the documents would send nearly every document
to every region.  The first pivots are therefore the one-shingle sets: a
document lies nearest to those whose shingle it holds, and a global order of
shingles (rare ones first) breaks the ties.  Two sets within the radius differ
in so few shingles that each one's first ``n - ceil(t n) + 1`` pivots must hold a
common one; a document is replicated to just these regions (its window).

Within a region, documents are the pivots: the member with the smallest hash
leads it, and regions that one document leads are joined as one.  A small region is
compared in one task, and members that are connected already are passed over.
In a larger one every member's exact distance to the lead is found and it
splits into rings by that distance.  By the triangle inequality a pair
within the radius lies in the same or in adjacent rings, so members are
replicated to one ring more, and the rings join recursively.  A region whose
members are all connected already is done, which is what keeps a group of
thousands of near copies from meeting in pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogmesh.llm.common import byte_codes, drop_written, mix64, prefix_sums, shuffle_partitions, signed, span_hash, text_batches
from smogmesh.llm.common import tidily_written as written
from smogmesh.llm.links import smallest_reachable

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_hashes(rows: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row number, 64-bit hash) of every row's distinct shingles, sorted by row and hash.

    Words are runs of non-space bytes after lower-casing A-Z; a row with fewer
    than ``k`` words (but some) has its whole sequence as one shingle.
    """
    data = np.frombuffer(b"\n".join(rows) + b"\n", dtype=np.uint8)
    data = _LOWER[data]
    row_end = np.cumsum(np.fromiter(map(len, rows), dtype=np.int64, count=len(rows)) + 1)
    space = _SPACE[data]
    word = ~space
    start = np.flatnonzero(word & np.concatenate([[True], space[:-1]]))
    end = np.flatnonzero(word & np.concatenate([space[1:], [True]])) + 1
    h = span_hash(prefix_sums(data, byte_codes()), start, end)
    row = np.searchsorted(row_end, start, side="right")
    n_words = np.bincount(row, minlength=len(rows))
    first = np.cumsum(n_words) - n_words
    c = np.uint64(0xD6E8FEB86659FD93)

    def combined(width: int, at: np.ndarray) -> np.ndarray:
        out = np.full(len(at), np.uint64(width))
        for i in range(width):
            out = mix64(out * c + h[at + i])
        return out

    full = np.flatnonzero(np.arange(len(h)) + k <= (first + n_words)[row])
    rows_out, hashes = [row[full]], [combined(k, full)]
    for width in range(1, k):
        few = np.flatnonzero(n_words == width)
        rows_out.append(few)
        hashes.append(combined(width, first[few]))
    r, s = np.concatenate(rows_out), np.concatenate(hashes)
    order = np.lexsort((s, r))
    r, s = r[order], s[order]
    new = np.ones(len(r), dtype=bool)
    new[1:] = (r[1:] != r[:-1]) | (s[1:] != s[:-1])
    return r[new], s[new]


#: Pivots beyond the first ones needed: one for so many shingles.
_EXTRA = 20
#: A set counts as one group member for so many shingles.
_UNIT = 3_000
#: Levels of rings; members of regions that these leave large and unconnected meet in blocks.
_ROUNDS = 4
#: Class numbers leave the two lowest bits free, for flags of a pivot.
_CLASS = -4


def _texts(batch: pa.RecordBatch, lo: int, hi: int) -> list[bytes]:
    col = batch.column("_text").slice(lo, hi - lo).cast(pa.binary())
    return [v or b"" for v in col.to_pylist()]


def heavy_shingles(docs: DataFrame, k: int, *, sample_docs: int = 4_000, size: int = 200_000) -> np.ndarray:
    """The most frequent shingles of about ``sample_docs`` documents, least frequent first.

    They go last in the order of pivots.  The order is exact for any such
    list: it only decides how large regions are.  At most ``size`` hashes.
    """
    n = docs.count()
    part = docs.filter(F.pmod(F.xxhash64(F.lit("heavy"), "_id"), F.lit(max(1, n // sample_docs))) == 0)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for lo, hi in text_batches(batch, "_text", 1 << 20):
                _, h = shingle_hashes(_texts(batch, lo, hi), k)
                g, c = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(signed(g)), pa.array(c.astype(np.int64))], names=["g", "n"])

    counts = part.select("_text").mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
    top = counts.filter("n >= 3").orderBy(F.col("n").desc(), "g").limit(size).toPandas()
    return top["g"].to_numpy(dtype=np.int64)[::-1].copy()


def _profiles(docs: DataFrame, k: int, keep: Fraction, heavy: np.ndarray) -> DataFrame:
    """``_id, n, s1, s2, prefix``: set size, set identity and the pivots of each document.

    Of documents with one set, only the first that a task meets lists pivots
    (a task remembers some hundred thousand sets), so copies meet in no region.
    Rows without an id list none and stand for nobody.
    """
    shared = docs.sparkSession.sparkContext.broadcast(heavy)
    schema = pa.schema(
        [("_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("prefix", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]):
        late = shared.value
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for lo, hi in text_batches(batch, "_text", 1 << 20):
                r, h = shingle_hashes(_texts(batch, lo, hi), k)
                m = hi - lo
                n = np.bincount(r, minlength=m)
                ends = np.cumsum(n)
                s1 = np.zeros(len(h) + 1, dtype=np.uint64)
                s2 = np.zeros(len(h) + 1, dtype=np.uint64)
                np.cumsum(mix64(h + np.uint64(1)), out=s1[1:])
                np.cumsum(mix64(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), out=s2[1:])
                g = signed(h)
                order = np.lexsort((g, _ranks(g, late), r))
                # ceil(keep * n) shared shingles at least: the first n - that + x must hold x of them.
                length = np.where(n > 0, n - -(-(keep.numerator * n) // keep.denominator) + 1 + n // _EXTRA, 0)
                first, second = signed(s1[ends] - s1[ends - n]) & _CLASS, signed(s2[ends] - s2[ends - n])
                if len(seen) > 250_000:
                    seen.clear()
                keyed = batch.column("_id").slice(lo, m).is_valid().to_pylist()
                for i, same in enumerate(zip(first.tolist(), second.tolist())):
                    if not keyed[i]:
                        length[i] = 0
                        continue
                    if same in seen:
                        length[i] = 0
                    seen.add(same)
                place = np.arange(len(g)) - np.repeat(ends - n, n)
                chosen = place < np.repeat(length, n)
                offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                prefix = pa.ListArray.from_arrays(pa.array(offsets), pa.array(g[order][chosen]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id").slice(lo, m), pa.array(n.astype(np.int64)),
                        pa.array(first), pa.array(second), prefix,
                    ],
                    schema=schema,
                )

    return docs.mapInArrow(run, "_id long, n long, s1 long, s2 long, prefix array<long>")


def _bits(h: np.ndarray) -> bytes:
    """A bitmap of a set: shingle ``x`` sets bit ``x % size``, the size a power of two from the set's."""
    size = max(64, 1 << (len(h) - 1).bit_length()) if len(h) else 64
    marks = np.zeros(size, dtype=bool)
    marks[(h & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(marks, bitorder="little").tobytes()


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """``m, n, bits, items``: each row's set identity, size, bitmap and whole shingle set, sorted, as 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for lo, hi in text_batches(batch, "_text", 1 << 20):
                r, h = shingle_hashes(_texts(batch, lo, hi), k)
                n = np.bincount(r, minlength=hi - lo)
                cuts = np.concatenate([[0], np.cumsum(n)])
                s1 = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mix64(h + np.uint64(1)), dtype=np.uint64)])
                own = [h[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(s1[cuts[1:]] - s1[cuts[:-1]]) & _CLASS), pa.array(n.astype(np.int64)),
                        pa.array([_bits(x) for x in own], pa.binary()), pa.array([x.tobytes() for x in own], pa.binary()),
                    ],
                    names=["m", "n", "bits", "items"],
                )

    return docs.select("_text").mapInArrow(run, "m long, n long, bits binary, items binary")


def _alike(groups: DataFrame, keep: Fraction) -> DataFrame:
    """``r, i, j, m, comp, lead``: members that may link to another of their group, by their bitmaps.

    Two sets differ in at least as many shingles as their bitmaps do in bits, so no
    link is lost, and whole sets are sent for few others.  Groups with a lead stay whole.
    """
    names = ["r", "i", "j", "m", "comp", "lead"]

    def run(rows: pa.Table) -> pa.Table:
        lead, comp, n = (rows.column(c).to_numpy() for c in ("lead", "comp", "n"))
        if lead.any():
            return rows.select(names)
        bits = [np.frombuffer(x, dtype=np.uint64) for x in rows.column("bits").to_pylist()]
        size = min(map(len, bits))
        folded = np.stack([np.bitwise_or.reduce(x.reshape(-1, size)) for x in bits])
        wanted = np.zeros(len(bits), dtype=bool)
        for i in range(len(bits) - 1):
            apart = np.bitwise_count(folded[i + 1 :] ^ folded[i]).sum(axis=1, dtype=np.int64)
            most = (n[i] + n[i + 1 :]) * (keep.denominator - keep.numerator)
            near = (comp[i + 1 :] != comp[i]) & (apart * (keep.denominator + keep.numerator) <= most)
            wanted[i] |= near.any()
            wanted[i + 1 :] |= near
        return rows.select(names).filter(pa.array(wanted))

    return groups.groupBy("r", "i", "j").applyInArrow(run, "r long, i long, j long, m long, comp long, lead boolean")


def _linked(groups: DataFrame, keep: Fraction) -> DataFrame:
    """``r, m, other, n, ring``: what the members of each group ``r, i, j`` are to each other.

    Rows with ``other`` are links, enough of them to connect what the group's links
    connect; members of one component ``comp`` are not compared.  Where a group has its
    region's ``lead``, every other member also gives its size ``n`` and its ring about it.
    """
    schema = pa.schema([(c, pa.int64()) for c in ("r", "m", "other", "n", "ring")])

    def run(rows: pa.Table) -> pa.Table:
        m, lead = rows.column("m").to_numpy(), rows.column("lead").to_numpy()
        _, comp, count = np.unique(rows.column("comp").to_numpy(), return_inverse=True, return_counts=True)
        # The lead first, the largest component last: its members need not be looked up.
        order = np.lexsort((m, comp, count[comp], ~lead))
        m, comp, lead = m[order], comp[order], lead[order]
        sets = rows.column("items").take(pa.array(order)).to_pylist()
        n = np.array([len(x) // 8 for x in sets], dtype=np.int64)
        ends = np.cumsum(n)
        starts = ends - n
        values, items = np.unique(np.frombuffer(b"".join(sets), dtype=np.uint64), return_inverse=True)
        own = np.zeros(len(values), dtype=np.int32)
        found, ring = [], None
        for i in range(len(m) - 1):
            unlike = comp[i + 1 :] != comp[i]
            if not (lead[i] or unlike.any()):
                continue
            mine = items[starts[i] : ends[i]]
            own[mine] = 1
            same = np.add.reduceat(own[items[ends[i] :]], starts[i + 1 :] - ends[i], dtype=np.int64)
            own[mine] = 0
            total = n[i] + n[i + 1 :] - same
            if lead[i]:
                # floor(distance / radius) in whole numbers; the radius is 1 - keep.
                ring = (total - same) * keep.denominator // (total * (keep.denominator - keep.numerator))
            near = i + 1 + np.flatnonzero(unlike & (same * keep.denominator >= total * keep.numerator))
            met, at = np.unique(comp[near], return_index=True)
            found += [(m[i], x) for x in m[near[at]]]
            comp[np.isin(comp, met)] = comp[i]
        k, rest = len(found), 0 if ring is None else len(ring)
        r = np.full(k + rest, rows.column("r")[0].as_py(), dtype=np.int64)
        a, b = np.array(found, dtype=np.int64).reshape(k, 2).T
        if ring is None:
            return pa.table([pa.array(r), pa.array(a), pa.array(b), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64())], schema=schema)
        link = np.arange(k + rest) < k
        parts = [np.concatenate([a, m[1:]]), np.concatenate([b, m[1:]]), np.concatenate([a, n[1:]]), np.concatenate([a, ring])]
        masks = [None, ~link, link, link]
        return pa.table([pa.array(r), *[pa.array(x, mask=y) for x, y in zip(parts, masks)]], schema=schema)

    return groups.groupBy("r", "i", "j").applyInArrow(run, "r long, m long, other long, n long, ring long")


def _ranks(g: np.ndarray, late: np.ndarray) -> np.ndarray:
    """Place of each shingle in the order of pivots: that in ``late``, else -1; equal ones go by the shingle."""
    rank = np.full(len(g), -1, dtype=np.int64)
    if len(late):
        by_hash = np.argsort(late)
        sorted_late = late[by_hash]
        at = np.minimum(np.searchsorted(sorted_late, g), len(late) - 1)
        hit = sorted_late[at] == g
        rank[hit] = by_hash[at[hit]]
    return rank


def _shared(pivots: DataFrame, heavy: np.ndarray) -> DataFrame:
    """``r, m, open, rank``: the distinct pivots ``r`` that at least two classes list.

    ``m`` comes with two flags: listed among the pivots that count, and early.
    ``open`` rows are the former, where some member of the region is early.
    Copies list no pivots (see ``_profiles``) and a document lists each pivot
    once, so no pivot has more than a small share of all rows.
    """
    n = shuffle_partitions(pivots.sparkSession)
    dealt = pivots.repartition(n, "r").sortWithinPartitions("r", "m")
    late = pivots.sparkSession.sparkContext.broadcast(heavy)
    schema = pa.schema([("r", pa.int64()), ("m", pa.int64()), ("open", pa.bool_()), ("rank", pa.int64())])

    def done(r: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
        cls = m & _CLASS
        new = np.ones(len(r), dtype=bool)
        new[1:] = r[1:] != r[:-1]
        other = new.copy()
        other[1:] |= cls[1:] != cls[:-1]
        group = np.cumsum(new) - 1
        members = np.bincount(group, weights=other)
        early = np.bincount(group, weights=(m & 1) > 0) > 0
        keep = other & (members[group] > 1)
        opened = ((m & 2) > 0) & early[group]
        rank = _ranks(r[keep], late.value)
        return pa.RecordBatch.from_arrays(
            [pa.array(r[keep]), pa.array(cls[keep]), pa.array(opened[keep]), pa.array(rank)], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]):
        rest = None  # rows of the last pivot, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            r, m = batch.column("r").to_numpy(), batch.column("m").to_numpy()
            if rest is not None:
                r, m = np.concatenate([rest[0], r]), np.concatenate([rest[1], m])
            cut = int(np.searchsorted(r, r[-1], side="left"))
            rest = r[cut:], m[cut:]
            if cut:
                yield done(r[:cut], m[:cut])
        if rest is not None:
            yield done(*rest)

    return dealt.mapInArrow(run, "r long, m long, open boolean, rank long")


def _ringed(regions: DataFrame, ring: Column) -> DataFrame:
    """Regions ``r, m`` split into rings: each member in its own ring and, as a guest, in the next.

    Two members whose rings are the same or neighbours meet once.  Rings
    without a member of their own, or with one alone, are done.
    """
    places = F.array(*[F.struct((F.col("ring") + i).alias("g"), F.lit(1 - i).alias("home")) for i in (0, 1)])
    dealt = regions.select("r", "m", "n", ring.alias("ring")).repartition(shuffle_partitions(regions.sparkSession), "r")
    split = dealt.select("r", "m", "n", F.explode(places).alias("z")).select("r", "z.g", "m", "n", "z.home")
    own = Window.partitionBy("r", "g")
    counted = split.withColumn("h", F.sum("home").over(own)).withColumn("c", F.count(F.lit(1)).over(own))
    return counted.filter("h > 0 and c > 1").select(F.xxhash64("r", "g").alias("r"), "m", "n")


def _led(regions: DataFrame, label: DataFrame, level: int) -> DataFrame:
    """``r, m, n, comp``: members of the regions that are not connected yet; ``r`` is the region's lead.

    The lead is the member with the smallest hash.  Regions with one lead become one
    region: near copies share some dozens of pivots, and their regions, which hold
    nearly the same members, mostly have the same lead.
    """
    order = F.struct(F.xxhash64(F.lit(level), "m").alias("o"), F.col("m").alias("p"))
    own = Window.partitionBy("r")
    state = regions.join(label, "m").withColumn("lo", F.min("comp").over(own)).withColumn("hi", F.max("comp").over(own))
    state = state.withColumn("x", F.min(order).over(own)).filter("lo < hi")
    return state.select(F.col("x.p").alias("r"), "m", "n", "comp").distinct()


def _grouped(state: DataFrame, group: int, level: int) -> DataFrame:
    """``r, i, j, m, comp, lead``: the members of each region in groups that a task compares.

    A region of up to ``group`` members is one group.  Of a larger one of which few
    are outside its largest component, all pairs but those inside that component meet:
    its members are dealt to blocks, and blocks of the others meet every block.  A region
    with many others is first dealt to parts, each with the lead, which gives the
    rings; what these connect need not meet again.  Long sets count as several members.
    """
    weight = F.ceil(F.col("n") / _UNIT)
    by = state.groupBy("r", "comp").agg(F.sum(weight).alias("w"))
    kinds = by.groupBy("r").agg(F.sum("w").alias("w"), F.max(F.struct("w", "comp")).alias("x"))
    few = F.lit(True) if level >= _ROUNDS else F.col("w") - F.col("x.w") <= 2 * group
    kinds = kinds.select(
        "r", F.col("x.comp").alias("big"), (F.col("w") <= group).alias("whole"), few.alias("few"),
        F.ceil(F.col("w") / group).alias("parts"), F.ceil(2 * (F.col("w") - F.col("x.w")) / group).alias("others"),
        F.ceil(2 * F.col("x.w") / group).alias("most"),
    )
    h = F.xxhash64(F.lit(level), F.lit("block"), "m")
    place = (
        F.when(~F.col("few"), F.pmod(h, "parts"))
        .when(F.col("comp") == F.col("big"), F.col("others") + F.pmod(h, "most"))
        .otherwise(F.pmod(h, "others"))
    )
    met = F.expr("sequence(0L, if(comp = big, others, others + most) - 1)")
    groups = (
        F.when(F.col("whole"), F.array(F.struct(F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"))))
        .when(F.col("few"), F.transform(met, lambda y: F.struct(F.least("at", y).alias("i"), F.greatest("at", y).alias("j"))))
        .when(F.col("lead"), F.transform(F.expr("sequence(0L, parts - 1)"), lambda y: F.struct(y.alias("i"), y.alias("j"))))
        .otherwise(F.array(F.struct(F.col("at").alias("i"), F.col("at").alias("j"))))
    )
    lead = (F.col("m") == F.col("r")) & ~F.col("whole") & ~F.col("few")
    dealt = state.join(kinds, "r").withColumn("at", place).withColumn("lead", lead)
    return dealt.select("r", F.explode(groups).alias("z"), "m", "comp", "lead").select("r", "z.i", "z.j", "m", "comp", "lead")


def components(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80, group: int = 512
) -> DataFrame:
    """``key, n_shingles, class_id, component_id`` of every row of ``docs``.

    Two documents link if ``100 * |A and B| >= percent * |A or B|`` for their
    shingle sets A, B.  ``class_id`` is the smallest key with the same set,
    ``component_id`` the smallest key reachable by links.  Null texts and texts
    without words have the empty set and link with nothing.  Rows that repeat
    a key form one document per distinct set, and share a component if their
    sets do; rows with a null key take no part and get null ids.  An empty
    table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).cast("string").alias("_text"))
    keyed = rows.filter("_id is not null")
    keep = Fraction(percent, 100)
    heavy = heavy_shingles(keyed, k)
    listed = written(_profiles(rows, k, keep, heavy), "jaccard-profiles")
    prof = written(listed.select("_id", "n", "s1", "s2"), "jaccard-sizes")

    # Classes: documents with the same set.  One member stands for all; s1 names the class.
    full = "n > 0 and _id is not null"
    classes = written(prof.filter(full).groupBy("s1", "s2", "n").agg(F.min("_id").alias("rep")), "jaccard-classes")
    # Of two linked sets, the smaller holds their first common shingle still earlier: a
    # region needs a member that does.
    at, n = F.col("at"), F.col("n")
    early = at <= n - F.ceil(n * (2 * keep.numerator) / (keep.numerator + keep.denominator))
    core = at <= n - F.ceil(n * keep.numerator / keep.denominator)
    flags = F.when(early, 3).when(core, 2).otherwise(0)
    pivots = listed.filter(full).select("s1", "n", F.posexplode("prefix").alias("at", "r"))
    pivots = pivots.select("r", F.col("s1").bitwiseOR(flags.cast("long")).alias("m"))
    shared = written(_shared(pivots, heavy), "jaccard-shared")
    # A set linked to another has at least so many pivots in common with it, whichever the other's size.
    least = F.floor(F.ceil(n * keep.numerator / keep.denominator) / _EXTRA) + 1
    # Then it has the first of them, in the order of pivots, among those but its last `least - 1`.
    own = Window.partitionBy("m")
    placed = shared.join(classes.select(F.col("s1").alias("m"), "n"), "m")
    placed = placed.withColumn("at", F.row_number().over(own.orderBy("rank", "r"))).withColumn("c", F.count(F.lit(1)).over(own))
    regions = placed.filter("open").filter(F.col("at") <= F.col("c") - least + 1).select("r", "m", "n")
    # Sizes of linked sets differ by the factor `keep` at most: they lie in one or in neighbouring rings.
    ring = F.floor(F.log(F.col("n").cast("double")) / (math.log(1 / keep) * 1.01)).cast("long")
    regions = written(_ringed(regions, ring), "jaccard-regions")
    drop_written(listed, shared)

    wanted = written(regions.select("m").distinct(), "jaccard-wanted")
    reps = classes.select(F.col("rep").alias("_id"), "s1")
    # Written, so that its size is known: texts are shuffled only if the list is too long to broadcast.
    chosen_ids = written(reps.join(wanted, F.col("s1") == F.col("m"), "left_semi").select("_id").distinct(), "jaccard-ids")
    texts = keyed.join(chosen_ids, "_id", "left_semi")
    sets = written(_sets(texts, k), "jaccard-sets")
    rows_of = sets.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("m").alias("d")).first()
    if rows_of["n"] > rows_of["d"]:  # rows that repeat a key
        before, sets = sets, written(sets.dropDuplicates(["m"]), "jaccard-sets")
        drop_written(before)

    links = None
    label = wanted.withColumn("comp", F.col("m"))
    level = 0
    while True:
        state = written(_led(regions, label, level), "jaccard-open")
        drop_written(regions)
        if state.isEmpty():
            break
        groups = written(_grouped(state, group, level), "jaccard-groups")
        drop_written(state)
        alike = written(_alike(groups.join(sets.select("m", "n", "bits"), "m"), keep), "jaccard-alike")
        found = written(_linked(alike.join(sets.select("m", "items"), "m"), keep), "jaccard-linked")
        drop_written(groups, alike)
        close = written(found.filter("other is not null").select(F.col("m").alias("p"), F.col("other").alias("m")), "jaccard-links")
        links = close if links is None else links.unionByName(close)
        known, label = label, written(smallest_reachable(wanted, links, node="m", a="p", b="m", label="comp"), "jaccard-labels")
        if level:
            drop_written(known)
        # Next level: without the leads, in rings of the radius by distance to them.
        rest = found.filter("ring is not null")
        regions = written(_ringed(rest.select("r", "m", "n", "ring"), F.col("ring")), "jaccard-regions")
        drop_written(found)
        level += 1

    named = classes.join(label.select(F.col("m").alias("s1"), "comp"), "s1", "left")
    named = named.withColumn("comp", F.coalesce("comp", "s1"))
    smallest = named.groupBy("comp").agg(F.min("rep").alias("cid"))
    named = written(named.join(smallest, "comp").select("s1", "s2", "n", "rep", "cid"), "jaccard-named")
    out = prof.select("_id", "n", "s1", "s2").join(named, ["s1", "s2", "n"], "left")
    known = F.col("_id").isNotNull()
    return out.select(
        F.col("_id").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(known, F.coalesce("rep", "_id")).alias("class_id"),
        F.when(known, F.coalesce("cid", "_id")).alias("component_id"),
    )
