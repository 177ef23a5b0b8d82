"""One query per operator over its whole table, with the results that its contract names."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixelspark.llm import alignment, byte_bpe, chat, near_vectors, neighbours, ngram_join, packing, prefix_trie, quality, secrets, token_counts, token_files, toxicity
from pixelspark.llm.common import table
from pixelspark.llm.oracles import SQL

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.tiktoken"
ALIGN_A, ALIGN_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
TOKEN_LIMIT = 2048
FILE_END, PACK_END = 2, 1


def vocabulary(name: str) -> bytes:
    """A vocabulary file, read once on the driver; executors get its bytes."""
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"), 0.9)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    found = toxicity.scored(docs.select("doc_id", "lang", "text"), model)
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "flagged")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.spans(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("strong", lambda x: x["k"] == secrets.KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(secrets.written("strong"), 256).alias("base_sha256"),
                        secrets.written("all").alias("spans"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), 3, 90, 100)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary(WORD_BPE), TOKEN_LIMIT)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rendered(chat.repaired(table(spark, sf_dir, "conversations"))).drop("text")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), vocabulary(WORD_BPE), FILE_END)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary(BYTE_BPE), public_tokenizers.PATTERN)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents")).drop("rejected_by")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary(WORD_BPE), PACK_END)


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), 20, 20)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"), vocabulary(ALIGN_A), public_tokenizers.PATTERN, vocabulary(ALIGN_B))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_near_vectors, op2_toxicity, op3_secrets, op4_ngram_join, op5_token_counts, op6_chat_format, op7_token_files,
                            op8_byte_bpe, op9_quality_rules, op10_packing, op11_nearest_neighbours, op12_prefix_trie, op13_alignment)}
__all__ = ["QUERIES", "SQL"]
