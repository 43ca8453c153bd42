"""The array kernels against plain Python, without Spark."""

import random

import numpy as np
import public_tokenizers
import pytest

from smogmesh.llm import jaccard_join, packing, repeats, token_counts

ODD = ["", " ", "  a", "a\n\n b  \n", "▁x ▁", "日本語 テキスト、です。", "<s></s><unk>", "é  x　", "😀 a😀b", "12,345.67", "x" * 90, "a\x00b", "it's don't, .com"]


def test_suffix_array_matches_sorting():
    r = random.Random(0)
    for _ in range(60):
        rows = [bytes(r.choice(b"ab\x00\xff") for _ in range(r.randrange(0, 14))) for _ in range(r.randrange(1, 8))]
        owner, age, lcp = repeats.column_suffix_array(rows)
        got = [rows[o][len(rows[o]) - a :] for o, a in zip(owner, age)]
        assert got == sorted(s[i:] for s in rows for i in range(len(s)))
        for x in range(1, len(got)):
            both = 0
            while both < min(len(got[x]), len(got[x - 1])) and got[x][both] == got[x - 1][both]:
                both += 1
            assert lcp[x] == both


def test_token_count_of_every_prefix():
    import sentencepiece

    f = public_tokenizers.path("piece_bpe_32k.model")
    sp, c = sentencepiece.SentencePieceProcessor(model_file=f), token_counts.counter(f)
    for s in ODD:
        table = c.table(s)
        assert [int(x) for x in table] == [len(sp.encode(s[:i])) for i in range(len(s) + 1)]
    t = c.table("the quick brown fox jumps")
    assert token_counts.answer(t, budget=2) == max(i for i in range(len(t)) if t[i] <= 2)
    assert token_counts.answer(t, prefix=9) == len(sp.encode("the quick"))


def test_ids_are_the_library_s():
    from tokenizers import Tokenizer

    f = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(f)
    texts = ODD + ["It's THE don't'll x's,'s", "<|startoftext|> a<|endoftext|>b", "É̀ è Ωσς ΑΣ. İx", "é.x é,é÷×b ª.º", "a\x1cb　c d\x85e"]
    for text, got in zip(texts, packing.encoder(f).ids(texts)):
        assert list(got) == tok.encode(text, add_special_tokens=False).ids


def test_plan_fills_windows_and_takes_no_more_than_there_is():
    r = np.random.default_rng(3)
    histogram = {int(u): int(n) for u, n in zip(range(1, 33), r.integers(0, 400, 32))}
    plan = packing.plan_uses(histogram, 32)
    for cls, taken in plan.planned.items():
        assert taken <= histogram[cls]
    total = {}
    for cls, uses in plan.by_class.items():
        for _, per, times, seq, _ in uses:
            for k in range(times):
                total[seq + k] = total.get(seq + k, 0) + per * cls
    assert set(total) == set(range(plan.n_sequences)) and set(total.values()) <= {32}


@pytest.mark.parametrize("text,n", [(b"", 0), (b"  \n", 0), (b"one TWO", 1), (b"a b c d e", 1), (b"a b c d e f", 2), (b"a a a a a a a a", 1)])
def test_shingle_sets(text, n):
    rows, hashes = jaccard_join.shingle_hashes([b"x y", text, b""], 5)
    assert (rows == 1).sum() == n and (rows == 0).sum() == 1 and (rows == 2).sum() == 0
