"""A training corpus from the documents table, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogmesh.llm import jaccard_join, language_id, mixing, packing, repeats
from smogmesh.llm.common import ship, table, written
from smogmesh.llm.queries import TARGETS, WINDOW, tokenizer

#: A document whose language claims less than this share of its evidence has none of the learned languages.
MIN_LANGUAGE_SCORE = 0.3
#: Expected tokens after mixing, in units of the input's: enough that well-rated documents all stay.
MIX_BUDGET = 1.25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: ``und`` (null, empty and letterless texts) and texts without a clear claim go.

    The predicted language fills in where ``lang`` is null; a given one stays, as do all
    other columns, whatever their names.  Rows are judged one by one, repeated ones and
    those without an id too.  Without any labelled text nothing is known and all go;
    an empty table stays empty.
    """
    ship(spark)
    filters = language_id.fit_filters(docs)
    # Numbered names: a column of the documents may be called like one of the operator's.
    name = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    seen = language_id.identify(docs.toDF(*name.values()), filters, text=name["text"])
    kept = seen.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    own = {c: F.col(n) for c, n in name.items()}
    own["lang"] = F.coalesce(own["lang"], F.col("lang_pred"))
    return kept.select(*[own[c].alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Rows that repeat an id stay only once; rows without an id all stay.
    """
    ship(spark)
    found = jaccard_join.components(docs.select("doc_id", "text"))
    first = found.filter("doc_id = component_id").select("doc_id").distinct()
    first = written(first, "pipeline-first")
    keyed = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns)
    return keyed.unionByName(docs.filter("doc_id is null"))


def _readable(data: str) -> Column:
    """Bytes as text without the pieces of characters that a cut left over."""
    return F.regexp_replace(F.make_valid_utf8(F.col(data).cast("string")), "\uFFFD", "")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that an earlier text or place holds.

    A character that a removed stretch cuts through goes with it.  Documents
    of which nothing is left go.  Of rows that repeat an id one stays, that with the
    smallest text; rows without an id, and null and empty texts, stay as they are.
    Other columns stay, whatever their names.
    """
    ship(spark)
    if not docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        whole = F.struct(*docs.columns)
        first = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.min_by(whole, F.struct("text")).alias("_doc"))
        once = first.select("_doc.*").select(*docs.columns).unionByName(docs.filter("doc_id is null"))
        docs = written(once, "pipeline-once")
    kept = repeats.remove_repeats(docs.select("doc_id", "text"), with_text=True).filter("n_removed > 0 or doc_id is null")
    kept = written(kept.select("doc_id", "n_bytes", "n_removed", "kept"), "pipeline-kept")
    cut = kept.filter("doc_id is not null").select(
        F.col("doc_id").alias("_id"), _readable("kept").alias("_new"), (F.col("n_removed") < F.col("n_bytes")).alias("_left")
    )
    both = docs.join(cut, F.col("doc_id") == F.col("_id"), "left").filter("_new is null or _left")
    changed = F.col("_new").isNotNull()
    new = {"text": F.when(changed, F.col("_new")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("_new").cast("long")).otherwise(F.col("n_chars"))
    return both.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out by their rate, so that domains meet their weights.

    A document's rate is how often it is repeated (the part below one by a hash of its id).
    Rows that repeat an id share the largest of their rates; rows without an id stay
    once; texts without words stay once or twice, at the budget's rate.
    Columns stay as they are, whatever their names; an empty table stays empty.
    """
    ship(spark)
    labels = table(spark, sf_dir, "labels")
    rated = written(mixing.mix(docs, labels, TARGETS, budget=MIX_BUDGET), "pipeline-rated")
    return mixing.resampled(docs, rated)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of fixed token windows: ``packing.pack`` of all rows.

    A null or empty text is one end token; rows that repeat an id, or have none, are
    packed each; other columns are left out.  An empty table has no pieces.
    """
    ship(spark)
    return packing.pack(docs, tokenizer("word_bpe_49k.json"), window=WINDOW)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("passages", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: A logistic regression, an n-gram filter and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; stages are written in the session's shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
