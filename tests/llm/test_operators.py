"""Each operator against brute force on small tables, with nulls, empties, ties, repeats and extra columns."""

import base64
import hashlib
import math
import random
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from smogmesh.llm import fingerprints, jaccard_join, language_id, mixing, packing, repeats, token_counts, topk, url_filter, warc
from smogmesh.llm.queries import URL_RULES
from smogmesh.session import scratch_path

DOC = "doc_id long, text string, lang string, rank int, n int"


def _texts():
    r = random.Random(5)
    words = ["".join(r.choice("abcdeé") for _ in range(r.randrange(1, 6))) for _ in range(300)]
    base = [" ".join(r.choice(words) for _ in range(r.randrange(30, 120))) for _ in range(12)]
    out = [None, "", "  ", "one", "a b c d e", "a B c D e"]
    for b in base:
        w = b.split()
        for _ in range(4):
            x = list(w)
            for _ in range(r.randrange(0, 5)):
                x[r.randrange(len(x))] = r.choice(words)
            out.append(" ".join(x))
        out.append(b.upper())
    return out + ["z" * 3000, "q" * 250, base[0], base[0]]


TEXTS = _texts()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "ab" if i % 3 else None, 1, 2) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, DOC).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def test_repeats(docs, empty):
    seen, want = set(), []
    for i, t in enumerate(TEXTS):
        b = (t or "").encode()
        gone = np.zeros(len(b), dtype=bool)
        for j in range(len(b) - 99):
            s = b[j : j + 100]
            if s in seen:
                gone[j : j + 100] = True
            seen.add(s)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(b, dtype=np.uint8)[~gone].tobytes()
        want.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    assert sorted(map(tuple, repeats.remove_repeats(docs).collect())) == want
    assert repeats.remove_repeats(empty).count() == 0


def test_repeats_in_crowded_anchors(docs, spark):
    rows = repeats._keyed(docs, "doc_id", "text")

    def starts(crowd):
        found = repeats.repeated_spans(rows, crowd=crowd).collect()
        return {(r["id"], r["start"] + k) for r in found for k in range(r["strings"])}

    assert starts(1) == starts(20_000)


def test_repeated_keys_keep_one_copy(spark):
    r = random.Random(1)
    text = "".join(r.choice("abcdef") for _ in range(300))
    df = spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string")
    got = sorted((r["doc_id"] is not None, r["n_removed"]) for r in repeats.remove_repeats(df).collect())
    assert got == [(False, 0), (True, 300), (True, 300)]


def _sets():
    out = {}
    for i, t in enumerate(TEXTS):
        low = (t or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))
        w = [x for x in low.replace(b"\n", b" ").split(b" ") if x]
        out[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def test_jaccard_components(docs, empty):
    sets = _sets()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in range(i):
            same = len(sets[i] & sets[j])
            if sets[i] and 100 * same >= 80 * (len(sets[i]) + len(sets[j]) - same):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.components(docs).collect()}
    assert got == {i: (len(s), find(i)) for i, s in sets.items()}
    assert jaccard_join.components(empty).count() == 0


def test_top_k(spark):
    r = np.random.default_rng(2)
    vecs = [[float(x) for x in r.normal(size=12)] for _ in range(250)]
    vecs[7], vecs[8], vecs[9], vecs[11], vecs[100] = None, [None] * 12, [float("nan")] * 12, vecs[12], [0.0] * 12
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vecs)], "vec_id long, embedding array<float>, rank int")
    ok = {i: [int(np.floor(1024 * float(np.float32(x)))) for x in v] for i, v in enumerate(vecs) if i not in (7, 8, 9)}
    want = []
    for q in (0, 100, 200):
        scores = sorted((-sum(a * b for a, b in zip(ok[q], v)), i) for i, v in ok.items() if i != q)[:10]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert sorted(map(tuple, topk.top_k(df, block=32, query_block=2, step=4).collect())) == want
    assert topk.top_k(df.filter("vec_id < 0")).count() == 0


def test_top_k_of_wide_unequal_and_repeated_vectors(spark):
    r = random.Random(6)
    vecs = [(i, [r.choice((-1, 1)) * 10.0 ** r.uniform(-3, 30) for _ in range(r.randrange(0, 5))]) for i in range(60)]
    vecs += [(100, [1.0]), (1007, [3000.0]), (1008, [4000.0]), (1008, [4000.0]), (None, [9.0]), (200, [2.0**40, 1.0]), (9, [2.0**40, -1.0]), (10, [2.0**40, 0.0])]
    df = spark.createDataFrame([(i, v, "x", 2) for i, v in vecs], "vec_id long, embedding array<double>, score string, rank int").repartition(3)
    whole = [(i, [math.floor(1024 * x) if abs(1024 * x) < 2**53 else int(1024 * x) for x in v]) for i, v in vecs if i is not None]
    want = []
    for q, a in whole:
        if q % 100 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q)[:10]
            want += [(q, k + 1, i, -n if -(2**63) <= -n < 2**63 else None) for k, (n, i) in enumerate(found)]
    got = [tuple(x) for x in topk.top_k(df, block=16, query_block=2, step=2).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    two = sorted((x["rank"], x["vec_id"], x["score"]) for x in topk.top_k(df.filter("vec_id in (1007, 1008, 100)")).collect())
    assert two == [(1, 1008, 4194304000), (2, 1008, 4194304000), (3, 1007, 3145728000)]


def test_more_than_64_languages(spark):
    names = [f"l{i:03d}" for i in range(80)]
    r = random.Random(2)
    words = {n: ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(6)] for n in names}
    rows = [(i, " ".join(r.choice(words[n]) for _ in range(20)), n, 0, 0) for i, n in enumerate(names * 3)]
    filters = language_id.fit_filters(spark.createDataFrame(rows, DOC))
    assert filters.languages == names and filters.rows.shape[1] == 2
    probe = spark.createDataFrame([(i, " ".join(words[n]), n, 0, 0) for i, n in enumerate(names)], DOC)
    assert all(x["lang_pred"] == x["lang"] for x in language_id.identify(probe, filters).collect())


def test_language_masks_and_held_out_accuracy(spark):
    """Every n-gram's mask holds the languages whose exact set has it; held-out documents are told apart."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang is not null")
    apart = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    filters = language_id.fit_filters(docs.filter(~apart), max_grams=300)
    texts = {}
    for x in docs.filter(~apart).collect():
        texts.setdefault(x["lang"], []).append(x["text"] or "")
    share = {}
    for lang, own in texts.items():
        g, n = np.unique(language_id.grams(own)[1], return_counts=True)
        top = sorted(zip((-n).tolist(), g.view(np.int64).tolist()))[:300]
        share[lang] = {v: -c / n.sum() for c, v in top}
    every = {v for s in share.values() for v in s}
    exact = {v: {lang for lang, s in share.items() if s.get(v, 0) >= 0.5 * max(x.get(v, 0) for x in share.values()) and v in s} for v in every}
    packed = np.array(sorted(every), dtype=np.int64).view(np.uint64)
    mask = filters.languages_of(packed)[:, 0]
    extra = 0
    for v, m in zip(packed.view(np.int64).tolist(), mask.tolist()):
        held = {lang for i, lang in enumerate(filters.languages) if m >> i & 1}
        assert exact[v] <= held
        extra += len(held - exact[v])
    assert extra <= 0.02 * len(every) * len(share)
    full = language_id.fit_filters(docs.filter(~apart))
    test = language_id.identify(docs.filter(apart), full).collect()
    assert len(test) > 50 and sum(x["lang"] == x["lang_pred"] for x in test) >= 0.95 * len(test)


def test_jaccard_rows_without_a_key_stand_for_nobody(spark):
    words = [f"w{i}" for i in range(60)]
    a, b = " ".join(words), " ".join([*words[:30], "changed", *words[31:]])
    df = spark.createDataFrame([(None, a), (1, a), (2, b), (None, b)], "doc_id long, text string").coalesce(1)
    got = sorted((x["doc_id"] or 0, x["n_shingles"], x["component_id"]) for x in jaccard_join.components(df).collect())
    assert got == [(0, 56, None), (0, 56, None), (1, 56, 1), (2, 56, 1)]


@pytest.mark.parametrize("rows", [250_000, 0])
def test_warc_repeated_payloads_broadcast_or_not(spark, monkeypatch, rows):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", rows)
    pages = [(i, "u", f"page {i % 7}") for i in range(40)] + [(50, None, None), (51, "", ""), (None, "x", "page 3"), (60, "v", "alone"), (39, "u", "page 4")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    path = scratch_path(spark, "warc-repeats")
    warc.write_archives(df, path)
    best = {}
    for i, _, h in pages:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    want = [(i, "response" if (i if i is not None else -1) == best[h or ""] else "revisit", None if (i if i is not None else -1) == best[h or ""] else best[h or ""]) for i, _, h in pages]
    got = [(r["page_id"], r["record_type"], r["refers_to"]) for r in warc.archive_index(warc.read_records(spark, path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_warc_with_a_very_long_url(spark):
    df = spark.createDataFrame([(1, "http://x/" + "u" * 150_000, "<p>one</p>"), (2, "http://y", "<p>two</p>")], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-long")
    warc.write_archives(df, path)
    got = sorted((r["page_id"], r["payload_bytes"]) for r in warc.archive_index(warc.read_records(spark, path)).collect())
    assert got == [(1, 10), (2, 10)]


def test_language(spark, empty):
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(w) for _ in range(30)), lang, 1, 2) for i, (lang, w) in enumerate(
        [("xx", ["alpha", "beta", "gamma"]), ("yy", ["uno", "dos", "tres"])] * 20)]
    filters = language_id.fit_filters(spark.createDataFrame(rows, DOC))
    probe = [(1, "alpha gamma beta", None, 0, 0), (2, "tres dos", None, 0, 0), (3, None, None, 0, 0), (4, "12 !", None, 0, 0), (5, "", None, 0, 0)]
    got = {x["doc_id"]: (x["lang_pred"], x["score"]) for x in language_id.identify(spark.createDataFrame(probe, DOC), filters).collect()}
    assert (got[1][0], got[2][0], got[3], got[4], got[5]) == ("xx", "yy", ("und", 0.0), ("und", 0.0), ("und", 0.0))
    assert all(0 <= s <= 1 for _, s in got.values())
    nothing = language_id.fit_filters(empty)
    assert {x["lang_pred"] for x in language_id.identify(spark.createDataFrame(probe, DOC), nothing).collect()} == {"und"}
    assert language_id.identify(empty, filters).count() == 0


def test_urls(spark):
    urls = [
        ("http://a.NET/x", "a.net", "/x", "net/", "block"), ("https://w.example.net/en/1?q#z", "w.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"), ("x://q.org/fr/9", "q.org", "/fr/9", "org/fr/", "allow"),
        ("http://notexample.com/de/", "notexample.com", "/de/", None, None), ("http://a.net", "a.net", "", None, None),
        (None, "", "", None, None), ("nothing", "", "", None, None), ("a://É.org?x://y", "É.org", "", None, None),
    ]
    df = spark.createDataFrame([(i, u[0], "h", 0.5) for i, u in enumerate(urls)], "page_id long, url string, host string, score double")
    for r in url_filter.filter_urls(df, URL_RULES).collect():
        _, host, path, rule, verdict = urls[r["page_id"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    assert url_filter.filter_urls(df.filter("page_id < 0"), URL_RULES).count() == 0


def test_token_counts(docs, empty):
    import sentencepiece

    f = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=f)
    for r in token_counts.token_counts(docs, f, budget=40).collect():
        t = TEXTS[r["doc_id"]] or ""
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), len(sp.encode(t)), len(sp.encode(t)) > 40)
        assert len(sp.encode(t[: r["fits_chars"]])) <= 40
    tables = {r["doc_id"]: r["counts"] for r in token_counts.prefix_tables(docs, f).collect()}
    assert all(token_counts.answer(bytes(tables[i])) == len(sp.encode(t or "")) for i, t in enumerate(TEXTS))
    assert token_counts.token_counts(empty, f, budget=4).count() == 0


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    f = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(f)
    rows = packing.pack(docs, f, window=64).collect()
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, t in enumerate(TEXTS):
        ids, at = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert zlib.crc32(ids[at : at + r["length"]].tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(empty, f).count() == 0


def test_warc_round_trip(spark):
    inner = "x WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n\r\ny"
    rows = [(1, "u", inner), (2, None, None), (3, "a\r\nb", ""), (4, "é", "\r\n\r\n"), (5, "u", inner), (6, "v", "WARC/1.1\r\nContent-Length: 9\r\n\r\n"), (7, "w", "é" * 5000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    path = scratch_path(spark, "warc-test")
    warc.write_archives(df, path)
    got = {r["page_id"]: tuple(r)[1:] for r in warc.archive_index(warc.read_records(spark, path)).collect()}
    for k, _, html in rows:
        b = (html or "").encode()
        best = max(i for i, _, h in rows if (h or "") == (html or ""))
        kind = ("response", None) if best == k else ("revisit", best)
        assert got[k] == (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), *kind)
    path = scratch_path(spark, "warc-test")
    warc.write_archives(df.filter("page_id < 0"), path)
    assert warc.read_records(spark, path).count() == 0


def test_fingerprints(docs, empty):
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(docs).collect()}
    for i, t in enumerate(TEXTS):
        t, nxt = t or "", TEXTS[(i + 1) % len(TEXTS)] or ""
        m = len(t) // 4
        edited = t[: len(t) - m] + nxt[:m]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    n = len(TEXTS)
    assert got[n - 1]["fingerprint"] == got[n - 2]["fingerprint"] and got[n - 2]["near_next"] == 1.0
    assert fingerprints.fingerprints(empty).count() == 0


def test_mixing_meets_targets(spark, empty):
    r = random.Random(9)
    words = {0: ["fine", "good", "text"], 1: ["bad", "spam", "junk"], 2: ["awful", "curse", "rude"]}
    rows, labels = [], []
    for i in range(90):
        d = i % 3
        rows.append((i, " ".join(r.choice(words[d]) for _ in range(20 + i)), None, 0, 0))
        if i < 60:
            labels.append((i, 1 if d == 0 else 0, 1 if d == 2 else 0))
    df = spark.createDataFrame(rows + [(90, None, None, 0, 0)], DOC)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = mixing.mix(df, lab, {"good": 0.5, "poor": 0.3, "toxic": 0.2}).toPandas()
    total = got["n_tokens"].sum()
    for name, share in (("good", 0.5), ("poor", 0.3), ("toxic", 0.2)):
        assert abs((got["rate"] * got["n_tokens"] * got[f"p_{name}"]).sum() / total - share) < 0.02
    assert (got["rate"] >= 0).all() and len(got) == 91
    assert mixing.mix(empty, lab, {"good": 1.0}).count() == 0
    assert mixing.mix(df, lab.filter("doc_id < 0"), {"good": 1.0}).count() == 91


@pytest.mark.parametrize("rows", [250_000, 0])
def test_warc_bodies_are_shuffled_only_for_torn_records(spark, monkeypatch, rows):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", rows)
    whole = [(i, "u", f"body {i}") for i in range(30)]
    torn = [(100, "u", "a WARC/1.1\r\nContent-Length: 2\r\n\r\nb WARC/1.1\r\n c"), (101, "u", "WARC/1.1\r\n" * 3)]
    for pages in (whole, whole + torn):
        df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
        path = scratch_path(spark, "warc-torn")
        warc.write_archives(df, path)
        found = warc.read_records(spark, path)
        got = {int(r["headers"]["warc-record-id"][10:-1]): bytes(r["payload"]).decode() for r in found.collect()}
        assert got == {i: h for i, _, h in pages} and found.count() == len(pages)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        shuffled = [line for line in plan.splitlines() if "Aggregate" in line and "collect_list" in line or "Join LeftAnti" in line]
        assert bool(shuffled) == (len(pages) > len(whole))
        assert ("Join Inner" in plan) and ("rightHint=(strategy=broadcast)" in plan) == (len(pages) > len(whole) and rows > 0)


def test_language_tasks_drop_what_packing_kept_in_their_process(spark, monkeypatch):
    df = spark.createDataFrame([(1, "some words", "en"), (2, "quelques mots", "fr")], "doc_id long, text string, lang string")
    tasks, real = [], type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, *a, **k: tasks.append(f) or real(self, f, *a, **k))
    language_id.identify(df, language_id.fit_filters(df))
    assert len(tasks) == 2
    f = public_tokenizers.path("word_bpe_49k.json")
    for task in tasks:
        held = weakref.ref(packing.encoder(f))
        assert packing.encoder(f) is held()
        list(task(iter([])))
        assert held() is None


def _near_copies(n, seed=5):
    """Copies of a few texts with some words changed, near the radius: few pairs of a text's copies link."""
    r = random.Random(seed)
    bases = [[f"b{b}w{i}" for i in range(120)] for b in range(2)]
    rows = []
    for i in range(n):
        words = list(bases[i % 2])
        for at in r.sample(range(24), r.randrange(1, 4)) if i % 3 else r.sample(range(120), r.randrange(2, 7)):
            words[at] = f"x{r.randrange(3)}"
        rows.append((i, " ".join(words)))
    return rows


def _linked_components(rows):
    words = {i: t.split() for i, t in rows}
    sets = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, w in words.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in range(i):
            same = len(sets[i] & sets[j])
            if 100 * same >= 80 * (len(sets[i]) + len(sets[j]) - same):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("group, unit, rounds", [(8, 3_000, 4), (24, 50, 0)])
def test_jaccard_large_regions_equal_brute_force(spark, monkeypatch, group, unit, rounds):
    """Parts with rings, blocks and single groups find the same components."""
    monkeypatch.setattr(jaccard_join, "_UNIT", unit)
    monkeypatch.setattr(jaccard_join, "_ROUNDS", rounds)
    rows = _near_copies(140)
    want = _linked_components(rows)
    assert 3 < len(set(want.values())) < 100
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {x["doc_id"]: x["component_id"] for x in jaccard_join.components(df, group=group).collect()} == want


def test_jaccard_near_copies_meet_in_few_regions(spark, monkeypatch):
    """Near copies share dozens of pivots; what is kept of their regions grows with the copies alone."""
    kept, real = [], jaccard_join.written

    def written(df, name, **options):
        out = real(df, name, **options)
        if name == "jaccard-open":
            kept.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "written", written)
    rows = _near_copies(100)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {x["doc_id"]: x["component_id"] for x in jaccard_join.components(df).collect()}
    assert got == _linked_components(rows)
    assert 0 < max(kept) <= 8 * len(rows)
