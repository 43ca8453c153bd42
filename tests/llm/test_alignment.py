"""Token alignment and link counts against whole-text encodings and loops over all occurrence pairs."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from smogmesh.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, n_links string, pairs int"


def texts():
    r = random.Random(8)
    words = ["".join(r.choice("aeioustrnéüß") for _ in range(r.randrange(1, 9))) for _ in range(60)]
    out = [" ".join(r.choice(words) for _ in range(r.randrange(1, 80))) for _ in range(40)]
    odd = "aZ9 \n\t  　\u0085é日本𝒳🙂'’s.,!?<|>▁-\x00\x1c\x7f"
    out += ["".join(r.choice(odd) for _ in range(r.randrange(1, 60))) for _ in range(150)]
    out += ["".join(r.choice(odd.replace("▁", "")) for _ in range(r.randrange(1, 400))) for _ in range(60)]
    return out + [
        None, "", " ", "  ", "a ", " a", "a  b", "\n", " \n ", "<|endoftext|>", "x <s> </s> <unk>", "<0x41>", "a" * 5000, "ab" * 900 + "\n" * 40,
        "日本語" * 300, "𝒳🙂" * 120, "don't we'll I'M", out[0], out[0], "▁", "x▁y",
    ]


TEXTS = texts()


@pytest.fixture(scope="module")
def brute():
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    byte_of = alignment._byte_of()
    entry = {i: bytes(byte_of[c] for c in e) for e, i in tok.get_vocab(False).items()}

    def of(text):
        if not text:
            return None
        want = (" " + text).encode()
        a = tok.encode(" " + text, add_special_tokens=False).ids
        b = sp.encode(text)
        ab = [entry[i] for i in a]
        bb = [bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(ab) != want or b"".join(bb) != want:
            return None
        ae, be = np.cumsum([len(x) for x in ab]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        groups, i, j = [], 0, 0
        for cut in sorted(set(ae) & set(be)):
            p, q = ae.index(cut, i) + 1, be.index(cut, j) + 1
            groups.append((a[i:p], b[j:q]))
            i, j = p, q
        return groups

    return [of(t) for t in TEXTS]


def test_groups_equal_whole_text_encodings(brute):
    al = alignment.aligner(A, B)
    assert al.by_word
    stream, ends = al.tokens([t or "" for t in TEXTS])
    for t, lo, hi, want in zip(TEXTS, ends[:-1], ends[1:], brute):
        got = []
        for v in stream[lo:hi].tolist():
            if not got or got[-1][2]:
                got.append(([], [], False))
            a, b, _ = got[-1]
            (b if v & 1 else a).append(v >> 2)
            got[-1] = (a, b, bool(v & 1 and v & 2))
        assert [(a, b) for a, b, _ in got] == (want or []), repr(t)


def test_whole_texts_as_units_give_the_same(brute):
    al = alignment.Aligner(A, B)
    al.by_word = False
    stream, ends = al.tokens([t or "" for t in TEXTS])
    words, word_ends = alignment.aligner(A, B).tokens([t or "" for t in TEXTS])
    assert (stream == words).all() and (ends == word_ends).all()


def test_spans_that_do_not_fill_their_stretch():
    def ends(spans, sizes):
        s, e = np.array(spans).T
        out, bad = alignment.placed(s + 10, e + 10, np.array(sizes), np.zeros(len(sizes), dtype=int), np.array([10]))
        return None if bad[0] else (out - 10).tolist()

    assert ends([(0, 2), (2, 5), (2, 5), (5, 6)], [2, 1, 2, 1]) == [2, 3, 5, 6]
    assert ends([(0, 1), (1, 1), (1, 1), (1, 4)], [1, 1, 1, 1]) == [1, 2, 3, 4]
    assert ends([(0, 2), (2, 3)], [3, 1]) is None
    assert ends([(0, 0)], [1]) is None


def wanted(groups_of):
    links = []
    for groups in groups_of:
        links.append(Counter((a, b) for ga, gb in groups or [] for a in ga for b in gb))
    count = Counter(p for c in links for p in c)
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for groups, c in zip(groups_of, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups or [])
        out.append((
            sum(len(a) for a, _ in groups or []), sum(len(b) for _, b in groups or []), len(groups or []), sum(c.values()),
            sum(n for p, n in c.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in c.items()),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        ))
    return out


def test_groups_as_arrays(spark, brute):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], DOCS).repartition(3)
    for r in alignment.groups(alignment.tokens(df, A, B)).collect():
        want = brute[r["doc_id"]] or []
        assert r["a_ids"] == [x for a, _ in want for x in a] and r["b_ids"] == [x for _, b in want for x in b]
        assert (r["a_sizes"], r["b_sizes"]) == ([len(a) for a, _ in want], [len(b) for _, b in want])


def test_wide_ids_are_packed_in_four_bytes():
    for ids in ([], [0, 65_535], [1, 65_536, 2_000_000]):
        assert alignment._unpack(alignment._pack(np.array(ids, dtype=np.int64))).tolist() == ids


@pytest.mark.parametrize("most", [1 << 17, 40, 0])
def test_link_scores(spark, brute, most):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(TEXTS)], DOCS).repartition(5)
    packed = alignment.stored(alignment.tokens(df, A, B))
    got = sorted(map(tuple, alignment.link_scores(packed, most=most).collect()))
    assert got == [(i, *w) for i, w in enumerate(wanted(brute))]


def test_blocks_of_pairs_do_not_change_them(monkeypatch):
    r = np.random.default_rng(1)
    rows = []
    for _ in range(20):
        n = int(r.integers(0, 12))
        a, b = r.integers(1, 6, n), r.integers(1, 6, n)
        rows.append((r.integers(0, 9, a.sum()).tolist(), r.integers(0, 9, b.sum()).tolist(), a.tolist(), b.tolist()))
    def last(sizes):
        bits = np.zeros(sum(sizes), dtype=bool)
        bits[np.cumsum(sizes, dtype=int) - 1 if len(sizes) else []] = True
        return np.packbits(bits).tobytes()

    cells = [(alignment._pack(np.array(a, dtype=int)), alignment._pack(np.array(b, dtype=int)), last(x), last(y)) for a, b, x, y in rows]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*cells)], names=["a", "b", "a_last", "b_last"])

    def found():
        return [(int(x), int(p), int(t)) for part in alignment.Aligned(batch, 0, 20).pairs() for x, p, t in zip(*part)]

    want = Counter()
    for i, (a, b, sa, sb) in enumerate(rows):
        ia = ib = 0
        for x, y in zip(sa, sb):
            want.update((i, p << alignment.SHIFT | q) for p in a[ia : ia + x] for q in b[ib : ib + y])
            ia, ib = ia + x, ib + y
    assert sorted(found()) == sorted((i, p, t) for (i, p), t in want.items())
    monkeypatch.setattr(alignment, "BLOCK", 3)
    assert sorted(found()) == sorted((i, p, t) for (i, p), t in want.items())


def test_repeated_rows_null_keys_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "one two", "", 0), (1, "one two", "", 0), (None, "one", "", 0), (2, None, "", 0)], DOCS)
    got = alignment.link_scores(alignment.stored(alignment.tokens(df, A, B))).collect()
    by = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_links"], r["count_sum"]) for r in got)
    assert by == [(False, 1, 2, 5), (False, 1, 2, 5), (False, 2, 0, 0), (True, 0, 1, 3)]
    nothing = alignment.stored(alignment.tokens(df.filter("false"), A, B))
    assert alignment.link_scores(nothing).count() == 0 and alignment.groups(nothing).count() == 0
