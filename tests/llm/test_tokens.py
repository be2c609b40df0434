"""Encoding and splitting against the tokenizer itself."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lamina.llm import bytebpe as B
from lamina.llm import encode as enc
from lamina.llm import split as spl

tokenizers = pytest.importorskip("tokenizers")
ODD = ["", " ", "\n", "it's I'll 're ''s 's", "a  b\n\n\nc \t", "<|endoftext|> x", "日本語の文。次の文！", "👩‍🎨 ok", "x" * 3000, "a\u0000b", "don't've", "﻿é́", "   lead", "tail   "]


@pytest.fixture(scope="module")
def reference():
    t = tokenizers.Tokenizer.from_file(f"{B.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def kernel(texts):
    import pyarrow as pa

    data, off = B.plain(pa.array(texts, pa.string()))
    cuts, ends = B.pretokens(data, off)
    w = B.words(data, cuts)
    e = B.encode_words(w.dictionary, B.TOKENIZERS, "byte_bpe_50k")
    v, vo = B.gather(e.values.to_numpy(), e.offsets.to_numpy(), w.indices.to_numpy())
    return [v[vo[ends[i]] : vo[ends[i + 1]]].tolist() for i in range(len(texts))]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("a'b srtvelmd1 \n\t.é字 "), st.characters(exclude_categories=["Cs"])), max_size=30), min_size=1, max_size=6))
def test_kernel_equals_the_tokenizer(texts):
    t = tokenizers.Tokenizer.from_file(f"{B.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    assert kernel(texts) == [t.encode(x, add_special_tokens=False).ids for x in texts]


def frame(spark, texts):
    return spark.createDataFrame([(i if i % 5 else None, t, "clash", [1], 0) for i, t in enumerate(texts)], "doc_id long, text string, block string, ids array<int>, code int")


def test_encode_and_decode(spark, reference):
    texts = [None, *ODD, *ODD[:4], "word " * 4000]
    df = frame(spark, texts)
    rows = enc.encode(df).collect()
    assert sorted((r.doc_id or -1, tuple(r.ids)) for r in rows) == sorted(((i if i % 5 else -1), tuple(reference(t))) for i, t in enumerate(texts))
    back = enc.decode(enc.encode(df.filter("doc_id is not null"))).collect()
    assert sorted((r.doc_id, r.text) for r in back) == sorted((i, t or "") for i, t in enumerate(texts) if i % 5)


def test_encode_nothing(spark):
    assert enc.encode(frame(spark, []) if False else spark.createDataFrame([], "doc_id long, text string")).count() == 0


def pieces(spark, texts, limit, overlap, **kw):
    df = spark.createDataFrame([(i, t, 9, "x") for i, t in enumerate(texts)], "doc_id long, text string, piece int, pieces string")
    out = {}
    for r in spl.split(df, limit, overlap, **kw).orderBy("doc_id", "piece").collect():
        out.setdefault(r.doc_id, []).append(r)
    return out


@pytest.mark.parametrize("limit,overlap", [(16, 0), (16, 7), (64, 10)])
def test_pieces_cover_with_overlap(spark, reference, limit, overlap):
    r = random.Random(limit)
    word = lambda: r.choice(["alpha", "beta", "x1", "gamma.", "ß", "東京", "Ende!"])
    texts = [None, "", *["".join(word() + r.choice([" ", " ", "\n", "\n\n", "\n# "]) for _ in range(r.randint(1, 300))) for _ in range(25)], "y" * 2000, "漢字" * 300]
    got = pieces(spark, texts, limit, overlap)
    for i, t in enumerate(texts):
        n, p = len(reference(t)), got[i]
        assert p[0].token_from == 0 and p[-1].token_to == n and [x.piece for x in p] == list(range(len(p))) and {x.pieces for x in p} == {len(p)}
        assert (len(p) > 1) == (n > limit)
        assert all(x.token_to - x.token_from <= limit for x in p) and all(b.token_from == a.token_to - overlap for a, b in zip(p, p[1:]))
        if overlap == 0:
            assert "".join(x.text for x in p) == (t or "")


def test_cuts_by_brute_force(spark):
    r = random.Random(2)
    n = 400
    rank = np.array([r.choice([0, 1, 2, 2, 2, 3, 4, 5, 6]) for _ in range(n + 1)])
    begin, end = np.zeros(n + 1, int), np.full(n + 1, n)
    nxt = spl.successors(rank, begin, end, 40, 8)
    cuts, at = [0], 0
    while at < n:
        start = at if at == 0 else at - 8
        far = start + 40
        if far >= n:
            at = n
        else:
            low = max(at, start + 20)
            best = max((rank[c], c) for c in range(low + 1, far + 1))
            at = best[1]
        cuts.append(at)
    assert spl.all_cuts(nxt, np.array([0]), n).tolist() == cuts


def test_headings_are_preferred(spark):
    text = "".join(f"# Part {k}\n" + "word " * 30 + "\n\n" for k in range(8))
    p = pieces(spark, [text], 64, 0)[0]
    assert all(x.text.startswith("# Part") for x in p)


def test_only_oversized(spark, reference):
    texts = ["a " * 10, "b " * 600, None, "ü" * 900]
    got = pieces(spark, texts, 256, 32, only_cut=True, content=False)
    assert set(got) == {i for i, t in enumerate(texts) if len(reference(t)) > 256}
    with pytest.raises(ValueError):
        spl.split(spark.range(1), 10, 5)
