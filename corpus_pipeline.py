"""The corpus pipeline: toxicity, near copies, benchmark passages, mixture, token ids.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before
kept. The first four return the columns of ``documents``; the last returns one row per
document of the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quadrat.llm import decontaminate, mixing, neardup, tokenids, toxicity
from quadrat.llm.common import read
from quadrat.llm.queries import tokenizer_file
from quadrat.session import configure, cut_lineage


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what a classifier chain, trained on the labelled documents, rejects."""
    configure(spark)
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, the one with the smallest id."""
    configure(spark)
    return neardup.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a window of a benchmark item."""
    configure(spark)
    return decontaminate.remove_documents(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut or repeat the sources to their target weights; a row per copy."""
    configure(spark)
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token ids as Re-Pair shards; a row per document from the files."""
    configure(spark)
    return tokenids.token_table(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_each),
    ("decontamination", benchmark_free),
    ("mixture", mixed),
    ("token_ids", token_ids),
]

# Learned models and the tokenizer have no SQL form; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each stage reads what the one before wrote."""
    docs = read(configure(spark), sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
