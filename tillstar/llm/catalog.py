"""The numbered queries and the pipeline by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import (
    audit, bpe, chat, decontaminate, fingerprints, infill, lines, quality, simhash, spans,
    suffixes, toxicity, urls,
)
from tillstar.llm.tables import documents, hex_sha256, table
from tillstar.llm.training import fold

Query = Callable[[SparkSession, str], DataFrame]


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.with_next(documents(spark, sf_dir))
    chars = F.char_length("text")
    quarter = F.floor(chars / 4).cast("int")
    rows = rows.withColumns(
        {"n_chars": chars.cast("bigint"),
         "edited": F.concat(F.substr("text", F.lit(1), chars - quarter),
                            F.substr("next_text", F.lit(1), quarter))}
    )
    compared = fingerprints.compare_versions(
        rows, "text", {"edited": "edited", "next": "next_text"}
    )
    return compared.select(
        "doc_id", "n_chars", hex_sha256("edited").alias("edited_sha256"),
        "fingerprint", "edited_fingerprint",
        F.col("edited_likeness").alias("near_edited"), F.col("next_likeness").alias("near_next"),
        F.size("edited_lost").cast("bigint").alias("n_lost"),
        F.size("edited_only").cast("bigint").alias("n_added"),
    )


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.sql(
        "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    out = chat.format_conversations(turns.unionByName(probe), chat.INSTRUCT)
    read = out.withColumns(
        {"_turns": chat.turns_of(F.col("formatted"), chat.INSTRUCT),
         "_learnt": chat.loss_text(F.col("segments"))}
    )
    plain = F.transform(
        "_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    return read.select(
        "conv_id",
        F.size("_turns").cast("bigint").alias("n_turns"),
        hex_sha256(F.array_join(plain, "")).alias("turns_sha256"),
        F.char_length("_learnt").cast("bigint").alias("loss_chars"),
        hex_sha256("_learnt").alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
        "is_valid",
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return lines.drop_frequent_lines(docs).select(
        "row.doc_id", "n_lines", "n_dropped", hex_sha256("kept").alias("kept_sha256")
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(
        documents(spark, sf_dir), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        hex_sha256(F.array_join(F.sort_array("items"), ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", hex_sha256("kept").alias("kept_sha256")
    )


def _judged(scored: DataFrame, folds: int, held_out: int) -> DataFrame:
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    network = toxicity.fit(docs, labels, "toxic", fold(F.col("doc_id"), 5) != 0)
    return _judged(toxicity.score_documents(docs, network), 5, 0)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id"
    )


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.broadcast_ranks(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels, "quality", fold(F.col("doc_id"), 3) != 1)
    return _judged(quality.score_documents(docs, model), 3, 1)


def op10_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return spans.drop_repeated_spans(docs).select(
        "row.doc_id", "n_sentences", "n_removed", hex_sha256("kept").alias("kept_sha256")
    )


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = infill.restored(F.col("output"), F.col("form"))
    return infill.fill_in_middle(documents(spark, sf_dir)).select(
        "doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars",
        hex_sha256("output").alias("output_sha256"), hex_sha256(text).alias("restored_sha256"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = audit.failure_counts(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return audit.interactions(counts).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley",
    )


URL_RULES = [
    urls.Rule("block", "net", "/"), urls.Rule("allow", "example.net", "/en/"),
    urls.Rule("block", "example.com", "/de/"), urls.Rule("allow", "org", "/fr/"),
]


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge_urls(pages, URL_RULES).select(
        "row.page_id", "host", "path", "rule", "verdict", "score"
    )


QUERIES: dict[str, Query] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_line_dedup": op3_line_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_suffixes": op5_suffixes,
    "op6_toxicity": op6_toxicity,
    "op7_simhash": op7_simhash,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_quality": op9_quality,
    "op10_sentence_spans": op10_sentence_spans,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_filter_audit": op12_filter_audit,
    "op13_url_filters": op13_url_filters,
}
