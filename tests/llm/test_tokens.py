"""Both tokenizers' programmes against the libraries: every character in a context, and seeded odd strings."""

import random

import pytest
import sentencepiece
from tokenizers import Tokenizer

from leafgauge.llm import queries
from leafgauge.llm.bpe_prefix import piece_bpe, word_bpe

POOL = [" ", "  ", "▁", "\n", "\t", "a", "b", "'s", "<|endoftext|>", "Σ", "İ", "é", "̴", "ͅ", "½", "窈", "͸", "Ɤ", "1", "!", "​", "ﬁ", "가", "<s>", "<0x0A>"]


def odd_strings(n):
    rng = random.Random(3)
    for _ in range(n):
        yield "".join(rng.choice(POOL) if rng.random() < 0.7 else chr(rng.choice([rng.randrange(32, 0x3000), rng.randrange(0x10000, 0x20000)])) for _ in range(rng.randrange(1, 14)))


@pytest.fixture(scope="module")
def texts():
    alone = [f"a!{chr(c)}!b" for c in (*range(0xD800), *range(0xE000, 0x32000), *range(0xE0000, 0xE0200))]
    return alone + list(odd_strings(10_000))


def test_ids(texts):
    t, w = Tokenizer.from_file(queries.WORD_BPE), word_bpe(queries.WORD_BPE)
    want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    got = [memoryview(g).cast("I").tolist() if (g := w.encode(x)) else [] for x in texts]
    assert [x for x, a, b in zip(texts, got, want, strict=True) if a != b] == []


def test_counts(texts):
    s, p = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_BPE), piece_bpe(queries.PIECE_BPE)
    assert [x for x, n in zip(texts, map(len, s.encode(texts, num_threads=1)), strict=True) if p.count(x) != n] == []


def test_truncation(spark):
    from leafgauge.llm.token_counts import truncation_points

    s, p = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_BPE), piece_bpe(queries.PIECE_BPE)
    some = [None, "", *odd_strings(60)]
    rows = spark.createDataFrame(list(enumerate(some)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in truncation_points(rows, queries.PIECE_BPE, 5).collect()}
    for i, x in enumerate(some):
        within = max(k for k in range(len(x or "") + 1) if p.prefix_counts(x)[k] <= 5)
        assert (got[i]["n_tokens"], got[i]["keep_chars"]) == (len(s.encode(x or "")), within) and p.longest_within(x, 5) == within
    with pytest.raises(ValueError):
        truncation_points(rows, queries.PIECE_BPE, -1)


def test_long_texts_without_space():
    t, w = Tokenizer.from_file(queries.WORD_BPE), word_bpe(queries.WORD_BPE)
    s, p = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_BPE), piece_bpe(queries.PIECE_BPE)
    for x in ("ab" * 100_000, "x" * 200_000, "漢" * 50_000):
        got = w.encode(x)
        assert memoryview(got).cast("I").tolist() == t.encode(x, add_special_tokens=False).ids
        assert p.count(x) == len(s.encode(x))
