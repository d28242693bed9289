"""Corpus pipeline: each stage takes (spark, docs, sf_dir) and returns the documents it keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstar.llm.pipeline import STAGES, run_stages

#: SQL can express neither the toxicity score, nor SimHash's XXH64, nor the merges of BPE.
ORACLE_SQL = None

__all__ = ["ORACLE_SQL", "STAGES", "run"]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_stages(spark, sf_dir, STAGES)
