"""The thin ``opN_*`` queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake.llm import (chat_format, conversation_repair, decontaminate, line_dedup, near_dedup, passages, pieces,
                          quality_model, quality_rules, sharding, spelling, toxicity, url_filters)
from gamelake.llm.oracle import ORACLE  # noqa: F401
from gamelake.llm.tables import table, training_row

N_SHARDS = 40


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that contains a benchmark item, with the item."""
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 2-word shingles, similarity 0.8."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, pct=80).drop("class_id")


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted, read back and digested."""
    said = "</s>[INST] ok [/INST]"
    own = spark.range(0, 2, 1, 1).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat_format.digests(chat_format.prefix_examples(turns))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of the public 32k model; ``exact``: decoding gave the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encoded_documents(docs).select("doc_id", "n_pieces", "exact", "pieces")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of training rows."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, ["doc_id"]).select(
        "doc_id", (~training_row(F.col("doc_id"))).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word rules of every document and the verdict of its host (``source``)."""
    return quality_rules.filter_by_host(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url with its rule, or the verdict of its path template."""
    return url_filters.judge_urls(table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict", "template")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte ranges of passages that repeat an earlier document, one row a range."""
    return passages.repeated_passages(table(spark, sf_dir, "documents")).drop("text_hash")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels of training rows."""
    docs = table(spark, sf_dir, "documents")
    model = quality_model.learn(docs, table(spark, sf_dir, "labels"))
    return quality_model.scored(docs, model, ["doc_id"]).select(
        "doc_id", (~training_row(F.col("doc_id"))).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 40 shards of near equal bytes by virtual slots.

    ``next_shard`` is the shard under version 2 of the map, which has one more.
    """
    placed, _ = sharding.shard_documents(table(spark, sf_dir, "documents"), N_SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("position").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot", "next_shard")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and the repaired text's hash of every conversation, damaged by its rows' hashes."""
    return conversation_repair.audits(conversation_repair.damage(table(spark, sf_dir, "conversations"))).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its form, the root of its forms and its near words."""
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten or more documents have, as a hash."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.without_frequent_lines(docs, min_docs=10).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_minhash_dedup": op2_minhash_dedup,
    "op3_chat_format": op3_chat_format,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_toxicity": op5_toxicity,
    "op6_quality_rules": op6_quality_rules,
    "op7_url_filter": op7_url_filter,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_sharding": op10_sharding,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_line_dedup": op13_line_dedup,
}
