"""Rates against a dense solver; syncmers, sketches and likenesses against loops with another hash library."""

import hashlib
import random
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from smogmesh.llm import fingerprints, mixing, url_filter
from smogmesh.llm.queries import URL_RULES

DOCS = "doc_id long, text string, rate string, p_good int, next string, fingerprint int"


def words_of(domain, r, n):
    pool = {0: "abcde", 1: "fghij", 2: "klmno"}[domain]
    return " ".join("".join(r.choice(pool + "xyz") for _ in range(3)) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    r = random.Random(4)
    rows, labels = [], []
    for i in range(240):
        d = (0, 0, 0, 1, 1, 2)[i % 6]
        rows.append((i, words_of(d, r, r.randrange(5, 80)), "x", 1, "y", 2))
        if i % 2:
            labels.append((i, int(d != 1), int(d == 2), "t"))
    rows += [(300, None, "x", 1, "y", 2), (301, "", "x", 1, "y", 2), (7, rows[7][1], "x", 1, "y", 2), (None, rows[8][1], "x", 1, "y", 2)]
    labels += [(None, 1, 0, "t"), (1, None, None, "t"), (999, 1, 0, "t")]
    return spark.createDataFrame(rows, DOCS).repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


@pytest.mark.parametrize("targets, budget", [({"good": 0.8, "poor": 0.15, "toxic": 0.05}, 1.0), ({"good": 0.1, "poor": 0.1, "toxic": 0.8}, 1.5)])
def test_rates_against_a_dense_solver(corpus, targets, budget):
    docs, labels = corpus
    got = mixing.mix(docs, labels, targets, budget=budget, rounds=400, tolerance=1e-9).collect()
    assert len(got) == 244
    p = np.array([[x["p_good"], x["p_poor"], x["p_toxic"]] for x in got])
    w = np.array([x["n_tokens"] for x in got], dtype=float)
    rate = np.array([x["rate"] for x in got])
    assert np.allclose(p.sum(axis=1), 1) and (rate >= 0).all()
    assert np.allclose(rate[w == 0], budget)
    # min |sum(rate w p) / sum(w) - t|^2 in the metric of the documents' spread + ridge * mean (rate - budget)^2
    t = budget * np.array([targets[d] for d in mixing.DOMAINS])
    total, ridge = w.sum(), 1e-3
    metric = np.linalg.inv((p * w[:, None]).T @ p / total + ridge * np.eye(3))

    def value(r):
        e = (r * w) @ p / total - t
        return e @ metric @ e + ridge * ((r - budget) ** 2 * w).sum() / total

    dense = np.full(len(w), budget)
    for _ in range(20_000):
        e = (dense * w) @ p / total - t
        dense = np.maximum(0, dense - (p @ (metric @ e) + ridge * (dense - budget)) / (1 + ridge))
    assert value(rate) <= value(dense) * (1 + 1e-3) + 1e-9
    assert np.allclose(rate[w > 0], dense[w > 0], atol=0.02)


def test_rates_of_empty_and_unlabelled_tables(corpus):
    docs, labels = corpus
    assert mixing.mix(docs.filter("false"), labels, {"good": 1.0}).count() == 0
    got = mixing.mix(docs, labels.filter("false"), {"good": 1 / 3, "poor": 1 / 3, "toxic": 1 / 3}).collect()
    assert all(abs(x["rate"] - 1) < 1e-6 for x in got)


def test_posteriors_run_the_model_once_per_row(corpus):
    docs, labels = corpus
    found = mixing.posteriors(docs, labels)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF(" in plan and "lambda" not in plan
    assert all(len(r["p"]) == len(mixing.DOMAINS) and abs(sum(r["p"]) - 1) < 1e-9 for r in found.collect())
    two = mixing.posteriors(docs, labels.filter("toxic = 0")).collect()
    assert all(len(r["p"]) == len(mixing.DOMAINS) and r["p"][2] == 0 for r in two)


def xx(data: bytes, seed: int) -> int:
    return xxhash.xxh64_intdigest(data, seed)


def fold(numbers, seed=42):
    for n in numbers:
        seed = xx(struct.pack("<Q", n), seed)
    return seed


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def brute_anchors(text, k=fingerprints.K, s=fingerprints.S):
    """(position, hash) of the closed syncmers, straight from their definition."""
    w = [x for x in re.split("[ \t\n\r]+", (text or "").lower()) if x]
    h = [xx(x.encode(), 42) for x in w]
    if len(h) < k:
        return [(0, fold(h))] if h else []
    out = []
    for i in range(len(h) - k + 1):
        inner = [signed(fold(h[j : j + s])) for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append((i, fold(h[i : i + k])))
    return out


def brute_sketch(text):
    return sorted({h & 0xFFFFFFFF for _, h in brute_anchors(text)})[: fingerprints.SIZE]


def brute_likeness(a, b):
    union = sorted(set(a) | set(b))[: fingerprints.SIZE]
    return len(set(union) & set(a) & set(b)) / len(union) if union else 1.0


def test_fingerprints_against_loops(spark):
    r = random.Random(12)
    vocab = ["".join(r.choice("abcdeéZ") for _ in range(r.randrange(1, 5))) for _ in range(40)]
    texts = [" ".join(r.choice(vocab) for _ in range(r.randrange(0, 160))) for _ in range(50)]
    texts += [None, "", " \n\t ", "one", "a b c d", "a b c d e", "a a a a a a a a", texts[3], "𝒳 日本 é " * 30, "w " * 4000]
    df = spark.createDataFrame([(i * 3, t, "x", 1, "y", 2) for i, t in enumerate(texts)], DOCS).repartition(5)
    got = {x["doc_id"]: x for x in fingerprints.fingerprints(df).collect()}
    assert set(got) == {i * 3 for i in range(len(texts))}
    plain = [t or "" for t in texts]
    for i, t in enumerate(plain):
        nxt = plain[(i + 1) % len(plain)]
        swap = len(t) // 4
        edited = t[: len(t) - swap] + nxt[:swap]
        x = got[i * 3]
        own, other, follow = brute_sketch(t), brute_sketch(edited), brute_sketch(nxt)
        assert x["n_chars"] == len(t) and x["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert x["fingerprint"] == "".join(f"{v:08x}" for v in own)
        assert x["edited_fingerprint"] == "".join(f"{v:08x}" for v in other)
        assert abs(x["near_edited"] - brute_likeness(own, other)) < 1e-12
        assert abs(x["near_next"] - brute_likeness(own, follow)) < 1e-12
    table = {}
    for x in fingerprints.anchor_table(df).collect():
        table.setdefault(x["doc_id"], []).append((x["pos"], x["hash"]))
    for i, t in enumerate(plain):
        assert sorted(table.get(i * 3, [])) == sorted((p, signed(h)) for p, h in brute_anchors(t))


def test_an_edit_moves_no_anchor_elsewhere(spark):
    r = random.Random(5)
    a = [f"w{r.randrange(1000)}" for _ in range(120)]
    b = a[:60] + ["inserted", "words"] + a[60:]
    df = spark.createDataFrame([(1, " ".join(a), "", 0, "", 0), (2, " ".join(b), "", 0, "", 0)], DOCS)
    found = {1: set(), 2: set()}
    for x in fingerprints.anchor_table(df).collect():
        found[x["doc_id"]].add((x["pos"], x["hash"]))
    assert {x for x in found[1] if x[0] <= 55} == {x for x in found[2] if x[0] <= 55}
    assert {(p + 2, h) for p, h in found[1] if p >= 60} == {x for x in found[2] if x[0] >= 62}


def test_a_url_does_not_see_its_own_label(spark):
    r = random.Random(2)
    urls = [f"http://h{i}.{r.choice(('aa', 'bb'))}/x{r.randrange(9)}" for i in range(200)]
    label = [float(r.random() < 0.4) for _ in urls]

    def known(labels):
        rows = [(u, u.split("/")[2].split(".")[1], y) for u, y in zip(urls, labels)]
        return spark.createDataFrame(rows, "_url string, suffix string, label double")

    def shares(labels):
        df = known(labels)
        apart = url_filter.out_of_fold(url_filter.fold_counts(df))
        return {x["_url"]: x["suffix_block"] for x in df.withColumn("_fold", url_filter.fold_of(F.col("_url"))).join(apart, ["suffix", "_fold"]).collect()}

    fold = {x["_url"]: x["f"] for x in known(label).select("_url", url_filter.fold_of(F.col("_url")).alias("f")).collect()}
    got = shares(label)
    for u in urls:
        others = [y for v, y in zip(urls, label) if v.split("/")[2].split(".")[1] == u.split("/")[2].split(".")[1] and fold[v] != fold[u]]
        assert abs(got[u] - (sum(others) + 1) / (len(others) + 2)) < 1e-12
    flipped = shares([1 - label[0], *label[1:]])
    assert flipped[urls[0]] == got[urls[0]] and flipped != got


@pytest.mark.parametrize("small", [100_000, 0])
def test_urls_are_judged_by_learned_features(spark, monkeypatch, small):
    monkeypatch.setattr(url_filter, "BROADCAST_SUFFIXES", small)
    r = random.Random(7)
    rows = []
    for i in range(400):
        bad = i % 2
        tail = "".join(r.choice("0123456789") for _ in range(20)) if bad else "page"
        rows.append((i, f"http://site{i}.{r.choice(('info', 'biz'))}/{tail}" + ("?a=1&b=2&c=3" if bad else ""), "x"))
    labelled = spark.createDataFrame([(u.replace("site", "known"), "block" if i % 2 else "allow") for i, u, _ in rows], "url string, verdict string")
    df = spark.createDataFrame([*rows, (900, None, "x"), (3, rows[3][1], "x")], "page_id long, url string, suffix_block string").repartition(4)
    got = url_filter.filter_urls(df, URL_RULES, labelled=labelled).collect()
    assert len(got) == 402
    right = [x["verdict"] == ("block" if x["page_id"] % 2 else "allow") for x in got if x["page_id"] < 900]
    assert sum(right) >= 0.98 * len(right)
