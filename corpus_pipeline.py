"""A corpus pipeline of five stages over ``documents``: toxicity, quality rules, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pixelspark.llm import ngram_join, packing, quality, secrets, toxicity
from pixelspark.llm.common import stored, table
from pixelspark.llm.queries import PACK_END, WORD_BPE, vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold of their language."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.unflagged(docs, model)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all quality rules."""
    return quality.kept(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return ngram_join.representatives(docs, 5, 8, 10)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts."""
    return secrets.masked(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of the documents' tokens in sequences."""
    return packing.pack_documents(docs, vocabulary(WORD_BPE), PACK_END)


STAGES = [("toxicity", drop_toxic), ("quality_rules", drop_low_quality), ("ngram_jaccard_join", drop_near_duplicates),
          ("secret_scans", mask_secrets), ("best_fit_packing", pack_sequences)]
#: Training and tokenizing are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on what the one before it has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
