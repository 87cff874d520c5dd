"""The queries of this subpackage, each over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    codebooks,
    conversations,
    decontaminate,
    line_dedup,
    lm_score,
    mixing,
    neighbours,
    ngram_join,
    pii,
    quality,
    sharding,
    simhash_trie,
    token_counts,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join(_table(spark, folder, "documents"), k=3, share=90, per=100, n_links=True)


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """All sources to equal weight, as many rows as there are."""
    return mixing.mix(_table(spark, folder, "documents"))


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), share=0.8)


def op4_graph_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return neighbours.search(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op5_feistel_shards(spark: SparkSession, folder: str) -> DataFrame:
    digest = sharding.document_digest(_table(spark, folder, "documents"))
    sharded = sharding.shard(digest, ["doc_id", "size", "text_crc32"], shards=8)
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return pii.replace(_table(spark, folder, "documents"), key="surrogates of the test tables")


def op7_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score(_table(spark, folder, "documents"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup(_table(spark, folder, "documents"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    from public_tokenizers import path

    pieces = token_counts.load_pieces(path("piece_bpe_32k.model"))
    return token_counts.count_tokens(_table(spark, folder, "documents"), pieces)


def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(_table(spark, folder, "documents"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair(_table(spark, folder, "conversations"), damage=True)


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return codebooks.encode(_table(spark, folder, "embeddings"))


def op13_simhash_trie(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_trie.near_duplicates(_table(spark, folder, "documents"), radius=2)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_jaccard": op1_ngram_jaccard,
        "op2_mix_sources": op2_mix_sources,
        "op3_decontaminate": op3_decontaminate,
        "op4_graph_neighbours": op4_graph_neighbours,
        "op5_feistel_shards": op5_feistel_shards,
        "op6_surrogates": op6_surrogates,
        "op7_lm_score": op7_lm_score,
        "op8_line_dedup": op8_line_dedup,
        "op9_token_counts": op9_token_counts,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_vector_codes": op12_vector_codes,
        "op13_simhash_trie": op13_simhash_trie,
    }
