"""Stages of the corpus pipeline, each on (spark, docs, sf_dir); all but the last return the columns of docs."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, lines, mixing, near_dups, toxicity
from .common import read
from .queries import WORD_BPE

#: A line goes from a source if at least so many of its documents, and more than this part of them, contain it.
LINE_LEAST, LINE_RATIO = 5, 0.1
#: Weights of the sources in turn.
WEIGHTS = (5, 2, 1)


def _packed(docs):
    """docs as one struct column, so that no name of theirs meets one of ours."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("d")


def _unpacked(docs, **new):
    return [new.get(c, F.col("d")[c]).alias(c) for c in docs.columns]


def drop_toxic(spark, docs, sf_dir):
    """Documents with P(grade >= 1) of one half or more go; the model is fitted on this stage's documents and the labels.

    Null ids and texts are judged like others: a null text has no evidence and stays. Rows that repeat an id are judged each
    by its text. An empty table gives no rows; without labels of both kinds all stay. Other columns are handed on.
    """
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    rows = docs.select(_packed(docs), F.col("text").alias("t"))
    return toxicity.score(rows, model, "d", "t").where("p_toxic < 0.5").select(*_unpacked(docs))


def drop_lines(spark, docs, sf_dir):
    """Lines that many documents of a source contain go; a document that loses all keeps its row with an empty text.

    A null source is one with ''; a null text stays null, and its n_chars as it was; n_chars counts the new text. Rows that
    repeat an id are documents like others. An empty table gives no rows. Other columns are handed on.
    """
    rows = docs.select(_packed(docs), F.col("source").alias("host"), F.split("text", "\n").alias("lines"))
    kept = lines.drop_frequent_lines(rows, LINE_RATIO, LINE_LEAST).select("d", F.array_join("kept", "\n").alias("t"))
    return kept.select(*_unpacked(docs, text=F.col("t"), n_chars=F.coalesce(F.length("t").cast("bigint"), F.col("d")["n_chars"]) if "n_chars" in docs.columns else None))


def drop_near_copies(spark, docs, sf_dir):
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the document with the smallest id stays.

    Rows that repeat an id stay together with it; those without id or words stay. An empty table gives no rows. Other
    columns are handed on.
    """
    groups = near_dups.near_duplicates(docs, k=5, percent=80).where("not kept").select(F.col("doc_id").alias("i")).distinct()
    rows = docs.select(_packed(docs), F.col("doc_id").alias("i"))
    return rows.join(groups, "i", "left_anti").select(*_unpacked(docs))


def mix_sources(spark, docs, sf_dir):
    """Each document as often as the mix takes it, to the nearest whole copy; those without words or id stay once.

    Rows that repeat an id count together: each comes as often as the words taken of the id, divided by its words. A null
    source is one, the last. An empty table gives no rows. Other columns are handed on.
    """
    mixed = mixing.mix(docs, WEIGHTS).where("doc_id is not null").groupBy(F.col("doc_id").alias("i")).agg(F.sum("size").alias("size"), F.sum("taken").alias("taken"))
    times = mixed.select("i", F.expr("if(size = 0, 1, cast(round(taken / size) as int))").alias("times"))
    rows = docs.select(_packed(docs), F.col("doc_id").alias("i")).join(times, "i", "left").withColumn("times", F.coalesce("times", F.lit(1))).where("times > 0")
    return rows.select("d", F.explode(F.expr("sequence(1, times)")).alias("copy")).select(*_unpacked(docs))


def encode(spark, docs, sf_dir):
    """Rows (doc_id, n_tokens, ids_sha256, decoded_sha256): token ids and digests of every copy.

    A null text counts as empty, a null id stays null, each row gives one, repeated rows too; an empty table gives none.
    Other columns are not handed on.
    """
    return bpe.digests(bpe.encode_decode(docs, WORD_BPE))
