"""The stages on small tables: nulls in any column, empty and long texts, repeats, ties, empty tables, clashing names."""

import random

import pytest

import corpus_pipeline as cp

SF = "/root/testdata/sf0.001"
#: Columns of documents and some with the names that the operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, n_removed int,"
    " n_bytes string, kept int, rate string, n int, m string"
)


def row(i, text, lang="en", score=77.0):
    return (i, text, lang, "s", None if text is None else len(text), score, "zz", 5, "b", 6, "r", 7, "m")


def sentence(r, words=40):
    return " ".join("".join(r.choice("etaoinshr") for _ in range(r.randrange(2, 9))) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    plain = [sentence(r) for _ in range(30)]
    long = " ".join(sentence(r, 200) for _ in range(60))
    out = [row(i, t) for i, t in enumerate(plain)]
    out += [row(100, None), row(101, ""), row(102, " \n"), row(103, plain[0]), row(None, plain[1]), row(None, None), row(104, long, None, None)]
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


def test_stages_are_named_in_order():
    assert [n for n, _ in cp.STAGES] == ["language", "near_duplicates", "passages", "mixing", "packing"]


@pytest.mark.parametrize("name, stage", cp.STAGES)
def test_empty_table(spark, name, stage):
    docs = spark.createDataFrame([], SCHEMA)
    out = stage(spark, docs, SF)
    assert out.count() == 0
    if name != "packing":
        assert out.columns == docs.columns


def test_language_keeps_other_columns(spark, rows):
    docs = frame(spark, rows)
    got = by_id(cp.identify_language(spark, docs, SF))
    want = by_id(docs)
    assert set(got) == set(want) - {100, 101, 102}
    assert len(got[None]) == 1  # that without a text goes
    for i, found in got.items():
        for r in found:
            src = next(x for x in want[i] if x["text"] == r["text"])
            assert r["lang"] == (src["lang"] or "en")
            assert [r[c] for c in docs.columns if c != "lang"] == [src[c] for c in docs.columns if c != "lang"]


def test_near_duplicates_keep_one_of_each_group(spark, rows):
    more = [*rows, rows[3], row(200, rows[2][1] + " tail"), row(201, rows[4][1].upper())]
    got = by_id(cp.drop_near_duplicates(spark, frame(spark, more), SF))
    assert set(got) == {*range(30), 100, 101, 102, 104, None}
    assert len(got[None]) == 2 and all(len(x) == 1 for i, x in got.items() if i is not None)


def test_passages_cut_and_whole_copies_go(spark, rows):
    r = random.Random(8)
    passage = sentence(r, 60)
    a, b = sentence(r), sentence(r)
    more = [*rows, row(300, a + " " + passage), row(301, b + " " + passage + " " + b[:20]), row(302, passage), rows[5], rows[5]]
    docs = frame(spark, more)
    got = by_id(cp.drop_repeated_passages(spark, docs, SF))
    assert 103 not in got and 302 not in got  # a copy of document 0; a passage alone
    assert len(got[5]) == 1 and got[5][0]["text"] == rows[5][1]
    assert got[300][0]["text"] == a + " " + passage
    left = got[301][0]
    assert left["text"].startswith(b) and passage[5:-5] not in left["text"] and left["n_chars"] == len(left["text"])
    assert (left["n_removed"], left["n_bytes"], left["kept"]) == (5, "b", 6)
    assert [x["text"] for x in got[100]] == [None] and got[101][0]["text"] == "" and len(got[None]) == 2


def test_mixing_repeats_or_drops_whole_rows(spark, rows):
    docs = frame(spark, [*rows, rows[7]])
    got = by_id(cp.mix_sources(spark, docs, SF))
    want = by_id(docs)
    assert set(got) <= set(want) and len(got[None]) == 2
    for i, found in got.items():
        assert {tuple(x) for x in found} <= {tuple(x) for x in want[i]}
    again = by_id(cp.mix_sources(spark, docs, SF))
    assert {i: len(x) for i, x in again.items()} == {i: len(x) for i, x in got.items()}


def test_packing_packs_every_row(spark, rows):
    docs = frame(spark, [*rows, rows[9]])
    pieces = cp.pack_windows(spark, docs, SF).collect()
    ends = [p for p in pieces if p["start"] + p["length"] == p["doc_tokens"]]
    assert len(ends) == len(rows) + 1
    windows = {}
    for p in pieces:
        windows.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_the_whole_run_keeps_clean_documents(spark):
    out = cp.run(spark, SF)
    ids = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert ids <= {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert len(ids) >= 0.5 * docs.count()
