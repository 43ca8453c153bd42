"""Mixing documents to target domain weights with soft membership.

A classifier fitted on a labelled table gives each document a posterior over
domains.  A rate per document is then sought, so that the expected tokens per
domain, ``sum(rate * tokens * posterior)``, meet the targets: non-negative
least squares solved by projected gradient steps, each one aggregate over all
documents.  Everything is DataFrame expressions and Spark ML.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smogmesh.llm.common import written

#: Domains of a labelled document, by its labels.
DOMAINS = ("good", "poor", "toxic")


def domain_of(quality: Column, toxic: Column) -> Column:
    """Number of the domain: toxic, else good or poor by quality; null if a label is missing."""
    return F.when(toxic == 1, 2).when((toxic == 0) & (quality == 1), 0).when((toxic == 0) & (quality == 0), 1)


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), "")


def posteriors(
    docs: DataFrame, labels: DataFrame, *, max_labelled: int = 6_000, features: int = 1 << 12
) -> DataFrame:
    """``_row, doc_id, n_tokens, p``: words and domain posterior of every whole text of ``docs``.

    The classifier (multinomial logistic regression on hashed word shares) is
    fitted on at most ``max_labelled`` labelled documents, those with the
    smallest hashes of their id.  With fewer than two domains among them, all
    documents get the labelled domains' shares (even shares without labels).
    """
    words = _words(F.col("text").cast("string")).alias("words")
    key = F.col("doc_id").cast("long").alias("doc_id")
    base = docs.select(F.monotonically_increasing_id().alias("_row"), key, words)
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), domain_of(F.col("quality"), F.col("toxic")).alias("label"))
        .filter("label is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    # At most max_labelled rows: small enough to send everywhere at any input size.
    sample = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    tf = HashingTF(inputCol="words", outputCol="tf", numFeatures=features)
    unit = Normalizer(inputCol="tf", outputCol="features", p=2.0)
    # Texts meet the sample before they are cut into words.
    marked = docs.select(key, "text").join(F.broadcast(sample), "doc_id").select("label", words)
    train = unit.transform(tf.transform(marked)).select("label", "features").persist()
    seen = {int(r["label"]): r["n"] for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = len(DOMAINS)
    if len(seen) < 2:
        train.unpersist()
        total = sum(seen.values())
        flat = [seen.get(d, 0) / total if total else 1 / n for d in range(n)]
        return base.select("_row", "doc_id", F.size("words").cast("long").alias("n_tokens"), F.array(*map(F.lit, flat)).alias("p"))
    model = LogisticRegression(family="multinomial", maxIter=30, regParam=1e-3).fit(train)
    train.unpersist()
    scored = model.transform(unit.transform(tf.transform(base)))
    # Classes are numbered from 0; a domain above the last seen one has no weight.  The vector is named
    # once: inside a function of the domain, hashing and model would run again for each domain.
    p = F.concat(vector_to_array("probability"), F.array_repeat(F.lit(0.0), n - model.numClasses))
    return scored.select("_row", "doc_id", F.size("words").cast("long").alias("n_tokens"), p.alias("p"))


def mix(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    *,
    budget: float = 1.0,
    rounds: int = 40,
    block: int = 8,
    ridge: float = 1e-3,
    tolerance: float = 1e-6,
    **fit,
) -> DataFrame:
    """``doc_id, n_tokens, p_good, p_poor, p_toxic, rate`` of every row of ``docs``.

    ``targets`` are the wanted shares of each domain in the expected tokens
    (normalised to 1); the wanted total is ``budget`` times the input's.  Rates minimise
    ``|sum(rate * tokens * p) / total - target|^2`` in the metric of the
    documents' own spread plus ``ridge`` times the tokens' mean squared
    departure of the rate from ``budget``, over all non-negative rates.

    A round's residual is one aggregate of as many numbers as domains.  Rates
    follow from the residuals so far, so a round writes nothing; every
    ``block`` rounds they are written, to keep that sequence short.  Texts
    without words have rate ``budget`` and weigh nothing.  Rows that repeat an id are
    rated each; empty tables give empty results; extra columns are ignored.
    """
    state = written(posteriors(docs, labels, **fit).withColumn("rate", F.lit(float(budget))), "mix-posteriors")
    n = len(DOMAINS)
    t = np.array([max(0.0, float(targets.get(d, 0.0))) for d in DOMAINS])
    t = budget * (t / t.sum() if t.sum() > 0 else np.full(n, 1 / n))
    p = [F.get("p", d) for d in range(n)]
    w = F.col("n_tokens").cast("double")
    sums = state.agg(
        F.coalesce(F.sum(w), F.lit(0.0)).alias("total"),
        *[F.coalesce(F.sum(w * p[i] * p[j]), F.lit(0.0)).alias(f"m{i}{j}") for i in range(n) for j in range(n)],
    ).first()
    if sums["total"] > 0:
        total = sums["total"]
        m = np.array([[sums[f"m{i}{j}"] / total for j in range(n)] for i in range(n)])
        metric = np.linalg.inv(m + ridge * np.eye(n))
        pending: list[np.ndarray] = []
        last = np.inf
        for k in range(rounds):
            rate = _stepped(pending, ridge, budget)
            got = state.agg(*[(F.sum(w * rate * p[i]) / total).alias(f"g{i}") for i in range(n)]).first()
            error = np.array([got[f"g{i}"] for i in range(n)]) - t
            if np.abs(error).max() < tolerance or abs(last - np.abs(error).max()) < tolerance * 1e-2:
                break
            last = float(np.abs(error).max())
            pending.append(metric @ error)
            if len(pending) == block:
                state = written(state.withColumn("rate", _stepped(pending, ridge, budget)), "mix-rates")
                pending = []
        state = state.withColumn("rate", _stepped(pending, ridge, budget))
    return state.select(
        "doc_id", "n_tokens", *[p[d].alias(f"p_{name}") for d, name in enumerate(DOMAINS)],
        F.when(F.col("n_tokens") > 0, F.col("rate")).otherwise(float(budget)).alias("rate"), "_row",
    )


def _stepped(steps: list[np.ndarray], ridge: float, budget: float) -> Column:
    """The rate after projected gradient steps along the given residuals."""
    if not steps:
        return F.col("rate")
    table = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])

    def step(r: Column, e: Column) -> Column:
        along = sum((F.get("p", d) * F.get(e, d) for d in range(1, len(DOMAINS))), F.get("p", 0) * F.get(e, 0))
        return F.greatest(F.lit(0.0), r - (along + ridge * (r - budget)) / (1.0 + ridge))

    return F.aggregate(table, F.col("rate"), step)


def resampled(docs: DataFrame, rated: DataFrame) -> DataFrame:
    """``docs`` with each row repeated by its rate: the whole part, and once more by chance.

    The chance is a hash of the row's id, so the result does not vary.  ``rated``
    is ``mix``'s result for the same rows, matched by id; rows that repeat an id
    share the largest of its rates, rows without an id stay once.
    """
    u = F.pmod(F.xxhash64(F.lit("mix"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    times = F.floor(F.col("rate") + u).cast("int")
    times = rated.filter("doc_id is not null").groupBy("doc_id").agg(F.max(times).alias("_times"))
    return (
        docs.join(times, "doc_id", "left")
        .withColumn("_times", F.coalesce("_times", F.lit(1)))
        .filter("_times > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
        .select(*docs.columns)
    )
