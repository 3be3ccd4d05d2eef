"""The corpus pipeline: stages that each write Parquet and hand it to the next.

Toxic documents go; one document of each near-duplicate group stays; passages that repeat
an earlier document are cut out; documents that contain a benchmark item go; the rest is
encoded into pieces and decoded again. Documents that a stage has no case against stay.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gamelake.llm import decontaminate, near_dedup, passages, pieces, toxicity
from gamelake.llm.tables import ship, table
from gamelake.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity limit, learned from the labels of training rows."""
    return toxicity.kept_documents(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at five words and similarity 0.8."""
    ship(spark)
    return near_dedup.kept_documents(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; ``n_chars`` follows the text."""
    ship(spark)
    cut = passages.remove_passages(docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.selectExpr(*("CAST(coalesce(length(text), n_chars) AS BIGINT) AS n_chars" if c == "n_chars" else f"`{c}`"
                            for c in docs.columns))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their pieces, and whether decoding gave the text back."""
    ship(spark)
    return pieces.encoded_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("decontamination", drop_benchmark_leaks),
    ("sentencepiece", encode),
]
ORACLE_SQL = None  # the stages learn models and run kernels in tasks: tested stage by stage against plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, "pipeline", uuid.uuid4().hex)
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.parquet(f"{base}/{k}-{name}")
    return docs
