"""Quality voting: kernels and votes against brute force, accuracy on held-out labels, odd rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from smogmesh.llm import quality
from smogmesh.llm.queries import op13_quality

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, score double, predicted string, _y int"
LABELS = "doc_id long, quality int, text string"


def test_repetition_terms():
    base = quality.TRIGRAMS + quality.SHAPES
    texts = ["a a a b", "", "x y\nx y\nx y", "one", "a b a b c"]
    got = quality.term_counts(texts)[:, base:].astype(int).tolist()
    # adjacent repeat, not; pair seen before, new; line seen before, new
    assert got == [[2, 2, 1, 2, 0, 1], [0] * 6, [0, 6, 3, 2, 2, 1], [0, 1, 0, 0, 0, 1], [0, 5, 1, 3, 0, 1]]


def test_trigrams_and_shapes_against_a_loop():
    r = random.Random(4)
    texts = ["".join(r.choice("aB 9é!\n") for _ in range(r.randrange(0, 60))) for _ in range(40)]
    got = quality.term_counts(texts)
    for t, row in zip(texts, got):
        b = t.encode()
        tri = Counter((int.from_bytes(b[i : i + 3], "big") * 2654435761) % 2**32 >> 20 for i in range(len(b) - 2))
        assert {i: int(v) for i, v in enumerate(row[: quality.TRIGRAMS]) if v} == dict(tri)
        shapes = []
        for w in b.replace(b"\n", b" ").split(b" "):
            cls = bytes(ord("a") if 97 <= c < 123 or c > 127 else ord("A") if 65 <= c < 91 else ord("0") if 48 <= c < 58 else c for c in w)
            if cls:
                shapes.append(bytes(c for i, c in enumerate(cls) if not i or cls[i - 1] != c))
        # Equal shapes share a term, and every word has one.
        assert row[quality.TRIGRAMS : quality.TRIGRAMS + quality.SHAPES].sum() == len(shapes)
    one, two = quality.term_counts(["Hello!! abC", "Word!!! zZ xyY"])[:, quality.TRIGRAMS : quality.TRIGRAMS + quality.SHAPES]
    assert one.argmax() in np.flatnonzero(two) and set(np.flatnonzero(one)) <= set(np.flatnonzero(two))


def test_a_text_has_the_same_counts_in_any_batch():
    r = random.Random(9)
    texts = ["".join(r.choice("ab \n!Zü") for _ in range(r.randrange(0, 200))) for _ in range(30)]
    alone = np.concatenate([quality.term_counts([t]) for t in texts])
    assert (quality.term_counts(texts) == alone).all()


def _rows():
    r = random.Random(1)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 7))) for _ in range(200)]
    out = []
    for i in range(160):
        w = [r.choice(words) for _ in range(r.randrange(20, 60))]
        text, y = (" ".join(w), 1) if i % 4 else (" ".join(x.upper() + "!!" for x in w), 0)
        out.append((i, text, y))
    return out


def _frames(spark, rows, labelled):
    docs = spark.createDataFrame([(i, t, 7.0, "x", 3) for i, t, _ in rows], DOCS).repartition(4)
    labels = spark.createDataFrame([(i, y, "zz") for i, _, y in rows if labelled(i)], LABELS)
    return docs, labels


def test_votes_against_brute_force(spark):
    rows = _rows()
    docs, labels = _frames(spark, rows, lambda i: i % 5)
    m = quality.fit(docs, labels, max_labelled=40, dims=8, neighbours=5)
    counts = np.concatenate([quality.term_counts([t]) for _, t, _ in rows])
    df = (counts > 0).sum(axis=0)
    assert np.allclose(m.idf, np.log(1 + len(rows) / (1 + df)))
    assert Counter(m.labels.tolist()) == {0.0: min(40, sum(1 for i, _, y in rows if i % 5 and not y)), 1.0: 40}
    got = {r["doc_id"]: r for r in quality.scores(docs, m).collect()}
    for (i, _, _), c in zip(rows, counts):
        z = m.latent(c[None, :])[0]
        cos = [int(a @ z) for a in m.points]
        edge = sorted(cos, reverse=True)[4]
        votes = [(w * (s / 2048**2) ** 8.0, y) for s, w, y in zip(cos, m.votes, m.labels) if s >= edge and s > 0]
        want = sum(v for v, y in votes if y) / sum(v for v, _ in votes)
        assert math.isclose(got[i]["score"], want, abs_tol=1e-9)
        assert got[i]["predicted"] == int(got[i]["score"] >= 0.3)
        assert math.isclose(got[i]["nearest"], max(0, min(1, max(cos) / 2048**2)), abs_tol=1e-6)


def test_the_basis_is_that_of_a_full_decomposition():
    x = np.random.default_rng(2).normal(size=(60, 30)) @ np.diag(np.linspace(5, 0.1, 30))
    _, s, vt = np.linalg.svd(x)
    b = quality._basis(x, 4, rounds=40)
    assert np.allclose(np.abs(np.sum(b * vt[:4].T, axis=0)), 1, atol=1e-6)


@pytest.fixture(scope="module")
def found(spark):
    return op13_quality(spark, SF).toPandas()


def test_held_out_accuracy(spark, found):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]).all()
    assert found.score.between(0, 1).all()
    both = found.merge(labels, on="doc_id")
    test = both[both.held_out]
    assert (test.predicted == test.quality).mean() >= 0.95
    assert test[test.quality == 1].predicted.mean() >= 0.97


def test_odd_rows(spark):
    rows = _rows()
    docs, labels = _frames(spark, rows, lambda i: True)
    more = spark.createDataFrame(
        [(500, None, 1.0, "", 0), (501, "", 1.0, "", 0), (502, " \n ", 1.0, "", 0), (None, rows[0][1], 1.0, "", 0), (1, rows[1][1], 1.0, "", 0),
         (503, "word " * 40_000, 1.0, "", 0), (504, "\U0001d4b3" * 50, 1.0, "", 0)], DOCS)
    odd = spark.createDataFrame([(None, 1, ""), (3, None, ""), (5, 7, ""), (9_999, 0, ""), (2, 0, ""), (500, 1, "")], LABELS)
    m = quality.fit(docs.unionByName(more), labels.unionByName(odd), dims=6)
    found = [tuple(r) for r in quality.scores(docs.unionByName(more), m).collect()]
    assert len(found) == len(rows) + 7 and all(0 <= r[1] <= 1 for r in found)
    by = {}
    for r in found:
        by.setdefault(r[0], []).append(r[1])
    assert by[1][0] == by[1][1] and by[None][0] == by[0][0]
    assert by[500] == by[501] == [m.prior]


def test_empty_tables_and_one_class(spark):
    rows = _rows()
    docs, labels = _frames(spark, rows, lambda i: True)
    nothing = docs.filter("false")
    m = quality.fit(nothing, labels)
    assert quality.scores(nothing, m).count() == 0
    m = quality.fit(docs, labels.filter("false"))
    assert {r["score"] for r in quality.scores(docs, m).collect()} == {0.5}
    m = quality.fit(docs, labels.filter("quality = 1"))
    assert {r["score"] for r in quality.scores(docs, m).collect()} == {1.0}
