"""URL filter: rules on host and path, gradient-boosted trees on lexical features for the rest.

A URL that a rule fits gets the rule's verdict.  All others are judged by a
gradient-boosted tree model fitted on labelled URLs.  Features are lexical:
length, depth, digit ratio, entropy, parameter counts and statistics of the
host's suffix.  Everything on the path is DataFrame functions and Spark ML.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogmesh.llm.common import written

#: Labelled rows a partition holds in training: every tree level is a job over all of them.
TRAIN_ROWS = 5_000
#: Parts that labelled URLs are dealt into for their own statistics.
FOLDS = 5
#: Suffixes whose statistics (a few dozen bytes each) may be sent to every task.
BROADCAST_SUFFIXES = 100_000

FEATURES = (
    "url_length", "host_length", "path_length", "host_depth", "path_depth", "digit_ratio", "host_digit_ratio",
    "hyphens", "host_entropy", "url_entropy", "n_params", "has_fragment", "secure", "suffix_share", "suffix_block",
)

#: Rules as (host, path, verdict); a rule's name is host + path.
Rule = tuple[str, str, str]


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host lower-cased in A-Z; both empty for a null URL or one without ``://``."""
    pattern = "://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null; equal lengths: first by name."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1]), reverse=False):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Shannon entropy in bits of the code points of a short text."""
    chars = F.split(text, "")
    chars = F.filter(chars, lambda c: c != "")
    n = F.size(chars).cast("double")

    def term(c: Column) -> Column:
        p = F.size(F.filter(chars, lambda x: x == c)) / n
        return -p * F.log2(p)

    bits = F.aggregate(F.transform(F.array_distinct(chars), term), F.lit(0.0), lambda a, b: a + b)
    return F.when(n > 0, bits).otherwise(F.lit(0.0))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def lexical(df: DataFrame) -> DataFrame:
    """Add the features that need one URL only, from the whole ``_url``, ``host`` and ``path``."""
    url = F.coalesce(F.col("_url"), F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    size = F.length(url).cast("double")
    return df.withColumns(
        {
            "url_length": size,
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "host_depth": _count(F.col("host"), r"\."),
            "path_depth": _count(F.col("path"), "/"),
            "digit_ratio": F.coalesce(F.try_divide(_count(url, "[0-9]"), size), F.lit(0.0)),
            "host_digit_ratio": F.coalesce(
                F.try_divide(_count(F.col("host"), "[0-9]"), F.length("host").cast("double")), F.lit(0.0)
            ),
            "hyphens": _count(F.col("host"), "-"),
            "host_entropy": _entropy(F.col("host")),
            "url_entropy": _entropy(F.col("path")),
            "n_params": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1.0),
            "has_fragment": url.contains("#").cast("double"),
            "secure": url.startswith("https:").cast("double"),
            "suffix": F.when(F.col("host").contains("."), F.substring_index("host", ".", -2)).otherwise(F.col("host")),
        }
    )


def fold_of(url: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("fold"), url), F.lit(FOLDS)).cast("int")


def fold_counts(known: DataFrame) -> DataFrame:
    """``suffix, _fold, _k, _b``: labelled and blocked URLs of each suffix and fold (equal URLs share a fold)."""
    return known.groupBy("suffix", fold_of(F.col("_url")).alias("_fold")).agg(
        F.count(F.lit(1)).alias("_k"), F.sum("label").alias("_b")
    )


def out_of_fold(folds: DataFrame) -> DataFrame:
    """``suffix, _fold, suffix_block``: the smoothed share of blocked labels among the suffix's other folds."""
    whole = folds.groupBy("suffix").agg(F.sum("_k").alias("_ka"), F.sum("_b").alias("_ba"))
    both = folds.join(whole, "suffix")
    share = (F.col("_ba") - F.col("_b") + 1.0) / (F.col("_ka") - F.col("_k") + 2.0)
    return both.select("suffix", "_fold", share.alias("suffix_block"))


def filter_urls(
    pages: DataFrame,
    rules: list[Rule],
    *,
    labelled: DataFrame | None = None,
    max_labelled: int = 20_000,
    threshold: float = 0.5,
    default: str = "allow",
) -> DataFrame:
    """Judge every row's ``url``: ``page_id, host, path, rule, verdict, score``.

    ``labelled`` is a table (url, verdict) to learn from; without it, the
    URLs that a rule decides are the labelled ones (a rule's verdict is a
    label given by hand).  The model is fitted on at most ``max_labelled`` of
    them, those with the smallest URL hashes; the suffix statistics cover all
    of them and all URLs, but a URL that is learned from sees those of the other
    folds of labels only.  ``score`` is the blocking probability (null where a
    rule decides).  If the labels hold fewer than two verdicts there is
    nothing to learn and ``default`` is given with a null score.

    Null URLs have empty host and path and zero features and are judged like
    any other; repeated rows give repeated results; an empty table gives an
    empty result.  Columns beyond page_id and url are ignored.
    """
    base = pages.select(F.col("page_id"), F.col("url").cast("string").alias("_url"))
    host, path = url_parts(F.col("_url"))
    judged = base.withColumns({"host": host, "path": path})
    judged = judged.withColumn("_m", matching_rule(F.col("host"), F.col("path"), rules))
    feats = lexical(judged)

    if labelled is None:
        known = feats.filter("_m is not null").withColumn("label", (F.col("_m.verdict") == "block").cast("double"))
    else:
        own = labelled.select(F.col("url").cast("string").alias("_url"), F.col("verdict").alias("_v"))
        h, p = url_parts(F.col("_url"))
        known = lexical(own.withColumns({"host": h, "path": p})).withColumn(
            "label", (F.col("_v") == "block").cast("double")
        )
    # Statistics of every suffix: its share of all URLs and its smoothed share of blocked labels.
    n_all = feats.agg(F.count(F.lit(1)).alias("n")).scalar()
    seen = feats.groupBy("suffix").agg(F.count(F.lit(1)).alias("_n"))
    folds = fold_counts(known)
    marks = folds.groupBy("suffix").agg(F.sum("_k").alias("_k"), F.sum("_b").alias("_b"))
    stats = seen.join(marks, "suffix", "left").select(
        "suffix",
        F.coalesce(F.try_divide(F.col("_n").cast("double"), n_all.cast("double")), F.lit(0.0)).alias("suffix_share"),
        F.coalesce((F.col("_b") + 1.0) / (F.col("_k") + 2.0), F.lit(0.5)).alias("suffix_block"),
    )
    stats = written(stats, "url-suffixes")
    # A few suffixes may hold all URLs: no join by suffix as long as their table is small.
    side = F.broadcast(stats) if stats.count() <= BROADCAST_SUFFIXES else stats
    fill = {"suffix_share": 0.0, "suffix_block": 0.5}

    sample = known.orderBy(F.xxhash64("_url"), "_url").limit(max_labelled)
    # A URL to learn from sees the labels of the other folds only, never its own.
    apart = out_of_fold(folds)
    learn = sample.join(side.drop("suffix_block"), "suffix", "left").withColumn("_fold", fold_of(F.col("_url")))
    learn = learn.join(apart, ["suffix", "_fold"], "left").na.fill(fill)
    train = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(learn)
    # At most max_labelled rows, whatever the input: a few partitions are enough.
    train = train.select("features", "label").repartition(max(1, max_labelled // TRAIN_ROWS)).persist()
    kinds = train.agg(F.min("label").alias("lo"), F.max("label").alias("hi")).first()
    rule = F.col("_m.rule").alias("rule")
    if kinds["lo"] is None or kinds["lo"] == kinds["hi"]:
        train.unpersist()
        return judged.select(
            "page_id", "host", "path", rule, F.coalesce("_m.verdict", F.lit(default)).alias("verdict"),
            F.lit(None).cast("double").alias("score"),
        )
    model = GBTClassifier(maxIter=10, maxDepth=4, seed=7, subsamplingRate=1.0).fit(train)
    train.unpersist()
    scored = model.transform(
        VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(feats.join(side, "suffix", "left").na.fill(fill))
    )
    p_block = F.element_at(_to_array("probability"), 2)
    return scored.select(
        "page_id",
        "host",
        "path",
        rule,
        F.coalesce("_m.verdict", F.when(p_block >= threshold, "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("_m").isNull(), p_block).alias("score"),
    )


def _to_array(name: str) -> Column:
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(name))
