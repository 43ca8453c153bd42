"""Language identification with bit-sliced Bloom filters of character n-grams.

Row r of the filter is a bit mask over the languages: bit l is bit r of
language l's Bloom filter.  Reading the rows of an n-gram's hashes and AND-ing
them returns all languages that hold the n-gram at once.  A text's n-grams
give a hit count per language; each count is corrected by the share of false
positives that the language's filter must give, and the corrected counts
decide.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smogmesh.llm.common import kept, mix64, text_batches

UNKNOWN = "und"
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters (built once per process)."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool))
    return _LETTERS[0]


def _fold(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased code points with 0 for all but letters, a 0 around each text; text starts; letters per text."""
    codes = np.frombuffer(("\0" + "\0".join(texts) + "\0").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    # Lower-casing may lengthen a text; the separators (not letters, and 0 only here) mark the texts.
    is_letter = _letters()[codes]
    return codes, is_letter, np.flatnonzero(codes == 0)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, packed n-gram) of every one of the texts' n-grams; letters per text.

    N-grams are the trigrams of letters within words, each word with a blank
    on either side, so that word starts and ends count; a trigram is packed
    into 63 bits.
    """
    texts = [t.replace("\0", " ") for t in texts]
    codes, is_letter, marks = _fold(texts)
    c = np.where(is_letter, codes, 0).astype(np.uint64)
    mid = is_letter[1:-1]
    packed = (c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:]
    at = np.flatnonzero(mid)
    text = np.searchsorted(marks, at + 1, side="right") - 1
    return text, packed[at], np.bincount(text, minlength=len(texts))


@dataclass
class Filters:
    """Bit-sliced Bloom filters: bit l of ``rows[r]`` (64 languages a word) is set if bit r of language l's filter is."""

    languages: list[str]
    rows: np.ndarray  # uint64, one column per 64 languages
    n_hashes: int
    false_positive: np.ndarray  # per language
    prior: int  # the language given where nothing decides

    def positions(self, packed: np.ndarray) -> list[np.ndarray]:
        a = mix64(packed + np.uint64(0x9E3779B97F4A7C15))
        b = mix64(a) | np.uint64(1)
        size = np.uint64(len(self.rows))
        return [((a + np.uint64(i) * b) % size).astype(np.int64) for i in range(self.n_hashes)]

    def languages_of(self, packed: np.ndarray) -> np.ndarray:
        """Mask of the languages that hold each n-gram, a row of words per n-gram."""
        mask = None
        for p in self.positions(packed):
            mask = self.rows[p] if mask is None else mask & self.rows[p]
        return mask

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score per text.

        The score is the winner's share of all languages' corrected hits
        above the runner-up's claim: between 0 (no evidence) and 1.
        """
        text, packed, letters = grams(texts)
        distinct, code = np.unique(packed, return_inverse=True)
        mask = self.languages_of(distinct) if len(distinct) else np.zeros((0, self.rows.shape[1]), dtype=np.uint64)
        n = letters.astype(np.float64)
        hits = np.empty((len(self.languages), len(texts)))
        for lang in range(len(self.languages)):
            bit = ((mask[:, lang // 64] >> np.uint64(lang % 64)) & np.uint64(1)).astype(np.float64)
            hits[lang] = np.bincount(text, weights=bit[code], minlength=len(texts))
        fp = self.false_positive[:, None]
        true = np.clip((hits - fp * n) / (1 - fp), 0, None)
        best = np.argmax(true, axis=0)  # ties: the language that sorts first
        top = true[best, np.arange(len(texts))]
        rest = true.sum(axis=0) - top
        score = np.divide(top, top + rest, out=np.zeros(len(texts)), where=top > 0)
        names = []
        for i in range(len(texts)):
            if letters[i] == 0:
                names.append(UNKNOWN)
                score[i] = 0.0
            else:
                names.append(self.languages[best[i] if top[i] > 0 else self.prior])
        return names, score


def fit_filters(
    labelled: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    max_docs: int = 2_000,
    max_grams: int = 6_000,
    ratio: float = 0.5,
    bits: int = 1 << 18,
    n_hashes: int = 4,
) -> Filters:
    """Learn the filters from rows with text and language.

    About ``max_docs`` documents per language are used, those with the
    smallest hashes of their key (all of them if there are fewer).  Of each language
    the ``max_grams`` most frequent n-grams can enter; an n-gram enters the
    filters of all languages whose relative frequency for it is at least
    ``ratio`` times the highest one.  The driver holds at most ``max_grams``
    n-grams per language; the filters have ``bits`` bits per language.
    """
    rows = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).cast("long").alias("_key"), F.col(text).cast("string").alias("_text"), F.col(lang).cast("string").alias("_lang")
    )
    counts = rows.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "_lang").collect()
    if not counts:
        return Filters([], np.zeros((1, 1), dtype=np.uint64), 1, np.zeros(0), 0)
    languages = sorted(r["_lang"] for r in counts)
    scale = 1 << 30
    cut = F.create_map(*[x for r in counts for x in (F.lit(r["_lang"]), F.lit(min(scale, scale * max_docs // r["n"])))])
    sample = rows.filter(F.pmod(F.xxhash64(F.lit("language"), "_key"), F.lit(scale)) < cut[F.col("_lang")])

    def count(batches: Iterator[pa.RecordBatch]):
        kept("language")
        for batch in batches:
            langs = np.array(batch.column("_lang").to_pylist(), dtype=object)
            for lo, hi in text_batches(batch, "_text", 1 << 20):
                t, packed, _ = grams(batch.column("_text").slice(lo, hi - lo).to_pylist())
                of = langs[lo:hi][t] if len(t) else np.zeros(0, dtype=object)
                for name in set(langs[lo:hi]):
                    g, n = np.unique(packed[of == name], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))],
                        names=["lang", "gram", "n"],
                    )

    found = sample.select("_text", "_lang").mapInArrow(count, "lang string, gram long, n long")
    per = found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    total = per.groupBy("lang").agg(F.sum("n").alias("t"))
    from pyspark.sql import Window

    # At most max_docs documents of a language give its n-grams: these windows are bounded.
    top = per.withColumn("_r", F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")))
    top = top.filter(F.col("_r") <= max_grams).select("lang", "gram", "n")
    table = top.join(total, "lang").select("lang", "gram", (F.col("n") / F.col("t")).alias("f")).toPandas()
    share = table.pivot_table(index="gram", columns="lang", values="f", fill_value=0.0).reindex(columns=languages, fill_value=0.0)
    values = share.to_numpy()
    keep = values >= ratio * values.max(axis=1, keepdims=True) if len(values) else np.zeros((0, len(languages)), bool)
    rows_ = np.zeros((bits, -(-len(languages) // 64)), dtype=np.uint64)
    filters = Filters(languages, rows_, n_hashes, np.zeros(len(languages)), 0)
    packed = share.index.to_numpy().astype(np.int64).view(np.uint64)
    for lang_no in range(len(languages)):
        for p in filters.positions(packed[keep[:, lang_no]]):
            np.bitwise_or.at(rows_[:, lang_no // 64], p, np.uint64(1 << lang_no % 64))
    for lang_no in range(len(languages)):
        load = float(((rows_[:, lang_no // 64] >> np.uint64(lang_no % 64)) & np.uint64(1)).mean())
        filters.false_positive[lang_no] = load**n_hashes
    filters.prior = languages.index(counts[0]["_lang"])
    return filters


def identify(docs: DataFrame, filters: Filters, *, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred`` and ``score``.

    ``und`` with score 0 if the text is null or has no letter; a text whose
    n-grams no filter holds gets the most frequent learned language with
    score 0.  If nothing was learned every text is ``und``.  Repeated rows get
    repeated results; columns of these names are replaced.  The filters travel
    with the task: their size is fixed by the fit's parameters.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]):
        kept("language")
        f = shared.value
        for batch in batches:
            for lo, hi in text_batches(batch, text, 1 << 20):
                part = batch.slice(lo, hi - lo)
                texts = [t or "" for t in part.column(text).to_pylist()]
                if f.languages:
                    names, score = f.predict(texts)
                else:
                    names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                    names=[*keep, "lang_pred", "score"],
                )

    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    from pyspark.sql import types as T

    schema = T.StructType(
        [docs.schema[c] for c in keep] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return docs.select(*keep).mapInArrow(run, schema)
