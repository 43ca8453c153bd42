"""Registered queries of the training-data operators over the test tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smogmesh.llm import alignment, clustering, fingerprints, jaccard_join, language_id, mixing, packing, quality, repeats, token_counts, topk, url_filter, warc
from smogmesh.llm.common import checkpoint_root, table
from smogmesh.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
#: Wanted shares of the expected tokens.
TARGETS = {"good": 0.80, "poor": 0.15, "toxic": 0.05}
TOKEN_LIMIT = 4096
WINDOW = 2048


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), TARGETS).drop("_row")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    apart = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    filters = language_id.fit_filters(docs.filter(~apart))
    return language_id.identify(docs.select("doc_id", "text"), filters).select(
        "doc_id", apart.alias("held_out"), "lang_pred", "score"
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"), budget=TOKEN_LIMIT
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), window=WINDOW)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint_root(spark)
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.archive_index(warc.read_records(spark, path))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centroids, _ = clustering.clusters(table(spark, sf_dir, "embeddings"))
    return clustering.with_inertia(assigned, centroids).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op12_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = alignment.tokens(
        table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
    )
    return alignment.link_scores(alignment.stored(packed))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.fit(docs, labels.filter(~held_out(F.col("doc_id"))))
    found = quality.scores(docs, model)
    apart = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    return found.select("doc_id", apart.alias("held_out"), "score", "predicted")


def queries() -> dict[str, Query]:
    import corpus_pipeline

    found = [
        op1_suffix_array_dedup, op2_mix, op3_top_k, op4_language_id, op5_url_filter, op6_token_counts,
        op7_jaccard_join, op8_packing, op9_warc, op10_fingerprints, op11_centroid_clusters, op12_cross_tokenizer,
        op13_quality,
    ]
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


#: The k best by brute force: every query vector against every other row.
_TOP_K_SQL = """
WITH e AS (
  SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
), bad AS (
  SELECT DISTINCT vec_id FROM e WHERE x IS NULL OR NOT isfinite(x)
), v AS (
  SELECT vec_id, i, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS q
  FROM e WHERE vec_id NOT IN (SELECT vec_id FROM bad)
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(sum(a.q * b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.i = b.i AND a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0 GROUP BY a.vec_id, b.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def _base32_sql(hex_digest: str) -> str:
    parts = []
    for group in range(8):
        value = f"CAST('0x' || substr({hex_digest}, {5 * group + 1}, 5) AS INTEGER)"
        parts += [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({value} >> {s}) & 31) + 1, 1)" for s in (15, 10, 5, 0)]
    return " || ".join(parts)


_WARC_SQL = f"""
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), m AS (
  SELECT h, max(page_id) AS best FROM p GROUP BY h
)
SELECT page_id, payload_bytes, {_base32_sql('p.h')} AS payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to
FROM p JOIN m ON p.h = m.h
"""


def _clusters_sql(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """Lloyd's rounds spelled out: every vector against every centroid, exact whole-number means."""
    parts = [
        f"""
sized AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, embedding FROM embeddings WHERE len(embedding) = {dims}
), bad AS (
  SELECT DISTINCT rid FROM (SELECT rid, unnest(embedding) AS x FROM sized) WHERE x IS NULL OR NOT isfinite(x)
), e AS MATERIALIZED (
  SELECT * FROM sized WHERE rid NOT IN (SELECT rid FROM bad)
), v AS MATERIALIZED (
  SELECT rid, vec_id, generate_subscripts(embedding, 1) AS i,
         CAST(floor(1024 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT) AS q FROM e
), seed AS (
  SELECT rid, row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)), rid) - 1 AS j
  FROM e WHERE vec_id IS NOT NULL
), c0 AS MATERIALIZED (
  SELECT CAST(seed.j AS INTEGER) AS j, v.i, v.q FROM seed JOIN v ON v.rid = seed.rid WHERE seed.j < {k}
)"""
    ]
    for t in range(rounds + 1):
        parts.append(
            f"""
, d{t} AS (
  SELECT v.rid, c.j, CAST(sum((v.q - c.q) * (v.q - c.q)) AS BIGINT) AS d
  FROM v JOIN c{t} c ON c.i = v.i GROUP BY v.rid, c.j
), a{t} AS MATERIALIZED (
  SELECT rid, j, d FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY d, j) AS r FROM d{t}) WHERE r = 1
)"""
        )
        if t < rounds:
            parts.append(
                f"""
, s{t} AS (
  SELECT a.j, v.i, CAST(sum(v.q) AS BIGINT) AS s, count(*) AS n FROM v JOIN a{t} a ON a.rid = v.rid GROUP BY a.j, v.i
), c{t + 1} AS MATERIALIZED (
  SELECT c.j, c.i, CASE WHEN s.n IS NULL THEN c.q ELSE CAST((s.s - (((s.s % s.n) + s.n) % s.n)) // s.n AS BIGINT) END AS q
  FROM c{t} c LEFT JOIN s{t} s ON s.j = c.j AND s.i = c.i
)"""
            )
    return (
        "WITH"
        + "".join(parts)
        + f"""
, h AS (
  SELECT j, sha256(string_agg(CAST(q AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY j
)
SELECT e.vec_id, a.j AS cluster, a.d AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.centroid_sha256
FROM a{rounds} a JOIN e ON e.rid = a.rid JOIN h ON h.j = a.j
"""
    )


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    sql = {"op3_top_k": _TOP_K_SQL, "op9_warc": _WARC_SQL, "op11_centroid_clusters": _clusters_sql()}
    if corpus_pipeline.ORACLE_SQL is not None:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
