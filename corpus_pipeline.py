"""From raw documents to token digests: the stages of the corpus pipeline."""

from __future__ import annotations

from leafgauge.llm import stages

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("line dedup", stages.drop_lines),
    ("near-duplicates", stages.drop_near_copies),
    ("mixing", stages.mix_sources),
    ("encoding", stages.encode),
]

#: The first stage fits a model, which SQL can't express; tests hold each stage against plain code.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Token digests of what the stages keep of the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
