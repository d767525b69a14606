"""The queries opN_<name>: each applies its operator to the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import ann, bpe, exact_search, licences, lines, mixing, near_dups, oracles, substrings, token_counts, toxicity
from .common import read

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 4096


def op1_licences(spark, sf_dir):
    return licences.scan(read(spark, sf_dir, "documents"))


def op2_ann(spark, sf_dir):
    return ann.nearest(read(spark, sf_dir, "embeddings"), k=20, every=20)


def op3_toxicity(spark, sf_dir):
    return toxicity.severity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_substrings(spark, sf_dir):
    return substrings.remove_repeats(read(spark, sf_dir, "documents"), window=13)


def op5_topk(spark, sf_dir):
    return exact_search.top_products(read(spark, sf_dir, "embeddings"), k=20, every=20)


def op6_bpe(spark, sf_dir):
    return bpe.digests(bpe.encode_decode(read(spark, sf_dir, "documents"), WORD_BPE))


def op7_near_dups(spark, sf_dir):
    return near_dups.near_duplicates(read(spark, sf_dir, "documents"), k=4, percent=80)


def op8_mixing(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents"))


def op9_token_counts(spark, sf_dir):
    out = token_counts.token_counts(read(spark, sf_dir, "documents"), PIECE_BPE)
    return out.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_line_dedup(spark, sf_dir):
    out = lines.dedup_pages(read(spark, sf_dir, "pages"))
    n, left = F.size("lines").cast("bigint"), F.size("kept").cast("bigint")
    return out.select("page_id", "host", n.alias("n_lines"), (n - left).alias("n_dropped"), F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_licences, op2_ann, op3_toxicity, op4_substrings, op5_topk, op6_bpe, op7_near_dups, op8_mixing, op9_token_counts, op10_line_dedup)}
ORACLE_SQL = {
    "op1_licences": oracles.LICENCES,
    "op4_substrings": oracles.SUBSTRINGS,
    "op5_topk": oracles.PRODUCTS,
    "op7_near_dups": oracles.NEAR,
    "op8_mixing": oracles.MIXING,
    "op10_line_dedup": oracles.LINES,
}
