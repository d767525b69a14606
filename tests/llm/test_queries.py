import sys
from pathlib import Path

import pytest
import sentencepiece
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from parity import PLACE, same

from leafgauge.llm import queries
from leafgauge.llm.bpe_prefix import piece_bpe, word_bpe

HARD = ["", " ", "aaaaaaa", "AA aa", "ΣΑΣ", "<|startoftext|>x<|endoftext|>", "it's WE'RE", "é", "\x1c a\x85\xa0b c", "12 3", "!!!...", "👍🏽 漢字", "\x00", "x" * 300, "<s> a</s>", "a  b   c ", "\n\na\n b", "▁▁x"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_and_sql_agree(spark, name):
    same(spark, queries.QUERIES[name], queries.ORACLE_SQL[name])


def test_tokenizers_agree(spark):
    t, s = Tokenizer.from_file(queries.WORD_BPE), sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_BPE)
    w, p = word_bpe(queries.WORD_BPE), piece_bpe(queries.PIECE_BPE)
    texts = HARD + [r["text"] for r in spark.read.parquet(f"{PLACE}/documents.parquet").collect()]
    for x in texts:
        ids = t.encode(x, add_special_tokens=False).ids
        got = w.encode(x)
        assert (memoryview(got).cast("I").tolist() if got else []) == ids
        assert w.decode(got) == t.decode(ids, skip_special_tokens=False)
        assert p.count(x) == len(s.encode(x))
    for x in HARD:
        assert p.prefix_counts(x) == [len(s.encode(x[:i])) for i in range(len(x) + 1)]


def test_pipeline_runs(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{PLACE}/documents.parquet")
    before = docs.count()
    for _, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, PLACE)
        assert out.columns == docs.columns
        docs = out
    assert 0 < docs.count() < before
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, PLACE)
    assert mixed.columns == docs.columns and mixed.groupBy("doc_id").count().where("count > 3").isEmpty()
    assert corpus_pipeline.STAGES[4][1](spark, mixed, PLACE).count() == mixed.count()
