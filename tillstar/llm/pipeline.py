"""Stages of the corpus pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import bpe, decontaminate, lines, simhash, toxicity
from tillstar.llm.tables import documents, table, written
from tillstar.llm.training import fold

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _judged(docs: DataFrame, verdicts: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` with their own verdict: the one of their id (null too) and their text."""
    own = verdicts.select(
        F.col("doc_id").alias("_of"), F.col("text_hash").alias("_hash")
    ).distinct()
    same = docs["doc_id"].cast("bigint").eqNullSafe(own["_of"])
    return docs.join(own, same & (F.xxhash64(docs["text"].cast("string")) == own["_hash"]), how)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the network scores 0.5 or more go; others of their id stay.

    Without labelled texts of both kinds there is no telling, and all documents stay.
    """
    labels = table(spark, sf_dir, "labels")
    network = toxicity.fit(docs, labels, "toxic", fold(F.col("doc_id"), 5) != 0)
    if not network.fitted:
        return docs
    scores = toxicity.score_documents(docs, network)
    return _judged(docs, scores.filter("score >= 0.5"), "left_anti")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; ``n_chars`` follows the text."""
    kept = lines.drop_frequent_lines(docs)
    changed = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("bigint")}
    return kept.select([changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest id stays, once.

    Rows without an id come after all others; of one id the least hash of the text decides. Groups
    are told apart by their fingerprints, as an id with several texts may be in several.
    """
    found = simhash.near_duplicates(docs)
    first = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "text_hash"))
    stays = found.groupBy("component").agg(first.alias("s")).select("s.doc_id", "s.text_hash")
    kept = _judged(docs, stays, "left_semi").withColumn("_hash", F.xxhash64(F.col("text").cast("string")))
    return kept.dropDuplicates(["doc_id", "_hash"]).drop("_hash")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a window of a benchmark item go; others of their id stay."""
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return _judged(docs, found.filter("n_hit > 0"), "left_anti")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks = bpe.broadcast_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_filter),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_dedup),
    ("benchmark_decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]


def run_stages(
    spark: SparkSession, sf_dir: str, stages: list[tuple[str, Stage]]
) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in stages[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return stages[-1][1](spark, docs, sf_dir)
