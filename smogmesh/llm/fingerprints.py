"""Document fingerprints from closed syncmers of words.

A text is a sequence of words.  A run of ``k`` words is a closed syncmer if
the smallest (by hash) of its runs of ``s`` words lies at the run's start or
end.  Whether a run is chosen depends on the run alone, so an edit elsewhere
moves no anchor: equal passages give equal anchors wherever they stand.  The
fingerprint is the sample of the smallest anchor hashes.

Everything here is SQL expressions over arrays: no Python code runs on rows.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, S, SIZE = 5, 2, 64
_DIGITS = 8


def words(text: Column) -> Column:
    """Lower-cased words of a text; empty array for a null or blank text."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \\t\\n\\r]+"), lambda w: w != "")


def anchors(word_hashes: Column, *, k: int = K, s: int = S) -> Column:
    """Array of structs (pos, hash): the closed syncmers, ``pos`` in words from 0.

    A text of fewer than ``k`` words (but at least one) has one anchor, the
    whole sequence.  Ties: a smallest inner run at either end counts, also
    if it occurs again between them.
    """
    h = word_hashes
    n = F.size(h)
    inner = k - s + 1

    def at(positions: Column, m: Column) -> Column:
        def chosen(i: Column) -> Column:
            low = F.array_min(F.slice(m, i + 1, inner))
            return (F.get(m, i) == low) | (F.get(m, i + inner - 1) == low)

        picked = F.filter(positions, chosen)
        return F.transform(
            picked, lambda i: F.struct(i.alias("pos"), F.xxhash64(F.slice(h, i + 1, k)).alias("hash"))
        )

    runs = F.transform(
        F.sequence(F.lit(0), n - s), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(s)])
    )
    whole = F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64(h).alias("hash")))
    # A one-element array around the run hashes names them, so they are made once per text.
    many = F.flatten(F.transform(F.array(runs), lambda m: at(F.sequence(F.lit(0), n - k), m)))
    none = F.array().cast("array<struct<pos:int,hash:bigint>>")
    return F.when(n >= k, many).when(n > 0, whole).otherwise(none)


def sketch(anchor_hashes: Column, *, size: int = SIZE) -> Column:
    """The ``size`` smallest distinct anchors, as hex words: a sorted array."""
    low = F.lit((1 << (4 * _DIGITS)) - 1)
    words32 = F.transform(anchor_hashes, lambda x: x.bitwiseAND(low))
    return F.slice(F.array_sort(F.array_distinct(words32)), 1, size)


def to_text(numbers: Column) -> Column:
    return F.concat_ws("", F.transform(numbers, lambda x: F.lower(F.lpad(F.hex(x), _DIGITS, "0"))))


def likeness(a: Column, b: Column, *, size: int = SIZE) -> Column:
    """Jaccard likeness of two anchor sets from their sketches: 1 if both are empty, 0 if one is."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, size)
    both = F.array_intersect(a, b)
    # Of the smallest anchors of both together, the share that both have.
    shared = F.size(F.array_intersect(union, both)).cast("double")
    n = F.size(union)
    return F.when(n == 0, F.lit(1.0)).otherwise(shared / n)


def fingerprint(text: Column, *, k: int = K, s: int = S, size: int = SIZE) -> Column:
    """Sketch of a text (array of numbers); ``to_text`` prints it."""
    hashes = F.transform(words(text), lambda w: F.xxhash64(w))
    found = F.flatten(F.transform(F.array(hashes), lambda h: F.transform(anchors(h, k=k, s=s), lambda x: x["hash"])))
    return sketch(found, size=size)


def anchor_table(docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """``key, pos, hash``: one row per anchor, for positional matching of documents."""
    hashes = F.transform(words(F.col(text)), lambda w: F.xxhash64(w))
    named = docs.select(F.col(key), hashes.alias("_h"))
    return named.select(key, F.explode(anchors(F.col("_h"), k=k, s=s)).alias("_a")).select(key, "_a.pos", "_a.hash")


def with_next(rows: DataFrame, key: str, tie: str, *, rows_per_range: int = 2_000) -> DataFrame:
    """Add ``next``, a struct of the row that follows by ascending ``key``; the last one's is the first.

    Rows are dealt into ranges of the key, split at approximate quantiles, so
    that no task orders more than about a range (10,000 ranges at most).  A
    copy of each range's first row goes to the range before as a guest, which
    the last row there finds as its follower.  Rows that repeat a key follow
    one another in the order of ``tie``; a null key counts as smallest.
    """
    names = rows.columns
    keyed = rows.withColumn("_o", F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)).cast("long")))
    keys = keyed.select("_o")
    n = keys.count()
    ranges = min(10_000, max(1, n // rows_per_range))
    cuts: list[int] = []
    if ranges > 1:
        probs = [i / ranges for i in range(1, ranges)]
        cuts = keys.agg(F.percentile_approx("_o", probs, 100_000)).first()[0]

    splits = [-math.inf, *sorted({float(c) for c in cuts}), math.inf]
    if len(splits) > 2:
        ranger = Bucketizer(splits=splits, inputCol="_d", outputCol="_r")
        deal = lambda df: ranger.transform(df.withColumn("_d", F.col("_o").cast("double"))).drop("_d")
    else:
        deal = lambda df: df.withColumn("_r", F.lit(0.0))
    low = deal(keys).groupBy("_r").agg(F.min("_o").alias("_o"))
    over_all = Window.orderBy("_r")  # one row per range
    wrap = Window.orderBy(F.col("_r").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    low = low.withColumn("_to", F.coalesce(F.lag("_r").over(over_all), F.first("_r").over(wrap)))
    # At most one row per range: bounded by the number of ranges.
    guests = keyed.join(F.broadcast(low.select("_o", "_to")), "_o")
    first = Window.partitionBy("_to").orderBy(tie)
    guests = guests.withColumn("_i", F.row_number().over(first)).filter("_i = 1").drop("_i")
    guests = guests.withColumn("_guest", F.lit(1)).withColumnRenamed("_to", "_r")
    both = deal(keyed).withColumn("_guest", F.lit(0)).unionByName(guests)
    order = Window.partitionBy("_r").orderBy("_guest", "_o", tie)
    return (
        both.withColumn("next", F.lead(F.struct(*names)).over(order)).filter("_guest = 0").select(*names, "next")
    )


def fingerprints(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", k: int = K, s: int = S, size: int = SIZE
) -> DataFrame:
    """Fingerprint of every whole text and of its edited text.

    The edited text is the text with its last floor(n / 4) code points
    replaced by the first as many (or all) of the next row's text, by
    ascending key, the last row being followed by the first.  Returns ``key,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``.

    Null texts count as empty; texts without words have the empty fingerprint,
    which is like any other empty one (likeness 1) and unlike all others (0).
    Repeated rows follow one another; a single row follows itself; an empty
    table gives an empty result; columns other than key and text are ignored.
    """
    own = docs.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    own = own.withColumn("_fp", fingerprint(F.col("_text"), k=k, s=s, size=size))
    led = with_next(own, key, "_text")
    n = F.length("_text")
    swap = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), n - swap), F.substring(F.col("next._text"), F.lit(1), swap))
    rows = led.select(key, n.cast("long").alias("n_chars"), "_fp", F.col("next._fp").alias("_next"), edited.alias("_edited"))
    rows = rows.withColumn("_efp", fingerprint(F.col("_edited"), k=k, s=s, size=size))
    return rows.select(
        key,
        "n_chars",
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        to_text(F.col("_fp")).alias("fingerprint"),
        to_text(F.col("_efp")).alias("edited_fingerprint"),
        likeness(F.col("_fp"), F.col("_efp"), size=size).alias("near_edited"),
        likeness(F.col("_fp"), F.col("_next"), size=size).alias("near_next"),
    )
