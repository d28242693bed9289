"""Benchmark decontamination: one Aho-Corasick automaton over the windows of test items."""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 10
#: Bytes of test items in one automaton. More items go to further automata, one scan each.
BLOCK_BYTES = 200_000

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)

SCANNED = (
    "doc_id bigint, text_hash bigint, n_words bigint, hit_words array<int>, items array<string>, "
    "spans array<struct<start:int,stop:int>>"
)

_automata: dict[str, ahocorasick.Automaton | None] = {}


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8; a word byte is a digit, a letter or any non-ASCII byte."""
    return (text or "").encode().translate(_WORD_BYTES).split()


def windows_of(words: list[bytes], size: int = WINDOW) -> list[bytes]:
    """All runs of ``size`` words; fewer words, but not none, are one window."""
    count = max(1, len(words) - size + 1) if words else 0
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(count)]


def build_automaton(items: list[tuple[str, str | None]], size: int) -> ahocorasick.Automaton | None:
    """Values are (number of words, ids of the items that have the window)."""
    owners: dict[bytes, set[str]] = defaultdict(set)
    for item, text in items:
        for window in windows_of(words_of(text), size):
            owners[window].add(item)
    if not owners:
        return None
    automaton = ahocorasick.Automaton()
    for window, ids in owners.items():
        automaton.add_word(window.decode("latin-1"), (window.count(b" ") - 1, tuple(sorted(ids))))
    automaton.make_automaton()
    return automaton


def scan(text: str | None, automaton: ahocorasick.Automaton | None):
    """Words, hit word numbers, items and hit stretches as code point offsets of the text."""
    raw = (text or "").encode()
    same_length = raw.translate(_WORD_BYTES)
    words = same_length.split()
    if automaton is None or not words:
        return len(words), [], [], []
    flat = b" " + b" ".join(words) + b" "
    found = list(automaton.iter(flat.decode("latin-1")))
    if not found:
        return len(words), [], [], []
    spaces = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
    ends = np.searchsorted(spaces, [end for end, _ in found])  # words up to the end of each match
    mark = np.zeros(len(words) + 1, np.int64)
    items: set[str] = set()
    for end, (_, (size, ids)) in zip(ends.tolist(), found):
        mark[end - size] += 1
        mark[end] -= 1
        items.update(ids)
    hit = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
    is_word = np.frombuffer(same_length, np.uint8) != 32
    edges = np.diff(np.concatenate(([0], is_word.astype(np.int8), [0])))
    starts, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    chars = np.concatenate(([0], np.cumsum(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)))
    breaks = np.flatnonzero(np.diff(hit) > 1)
    first = hit[np.concatenate(([0], breaks + 1))]
    last = hit[np.concatenate((breaks, [len(hit) - 1]))]
    spans = list(zip(chars[starts[first]].tolist(), chars[stops[last]].tolist()))
    return len(words), hit.tolist(), sorted(items), spans


def _scan_block(docs: DataFrame, items: Broadcast, size: int) -> DataFrame:
    key = uuid.uuid4().hex  # a worker builds the automaton once and keeps it for its next tasks
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_words", pa.int64()),
         ("hit_words", pa.list_(pa.int32())), ("items", pa.list_(pa.string())),
         ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))]
    )

    def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _automata:
            _automata.clear()
            _automata[key] = build_automaton(items.value, size)
        automaton = _automata[key]
        for batch in batches:
            out = [scan(t, automaton) for t in batch.column("text").to_pylist()]
            spans = [[{"start": a, "stop": b} for a, b in o[3]] for o in out]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"),
                 pa.array([o[0] for o in out], pa.int64()),
                 pa.array([o[1] for o in out], schema.field(3).type),
                 pa.array([o[2] for o in out], schema.field(4).type),
                 pa.array(spans, schema.field(5).type)],
                schema=schema,
            )

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(scan_batches, SCANNED)


def find_contamination(
    docs: DataFrame, items: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Words of ``docs`` inside any window of ``size`` words of the test ``items``.

    Returns ``doc_id, text_hash, n_words, n_hit, items (ids as sorted strings), spans`` for each
    row; spans are the hit stretches as code point offsets of the original text (within one block
    of items).
    Null or empty texts have no words. Items without words hit nothing; null ids of items show as
    "null"; equal items all count. Repeated documents give repeated rows.

    The items are a query set: they go to the executors in blocks of a checked size, one automaton
    and one scan of the texts for each block. The usual test sets are one block.
    """
    spark = docs.sparkSession
    items = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    scans = []
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        own = spark.sparkContext.broadcast([(r.item_id, r.text) for r in rows])
        scans.append(_scan_block(docs, own, size))
    if blocks == 1:
        return scans[0].select(
            "doc_id", "text_hash", "n_words", F.size("hit_words").cast("bigint").alias("n_hit"),
            "items", "spans",
        )
    # Each row of the documents comes once per block; equal rows are kept apart by their number.
    together = scans[0].withColumn("_block", F.lit(0))
    for block, part in enumerate(scans[1:], 1):
        together = together.unionByName(part.withColumn("_block", F.lit(block)))
    merged = together.groupBy("doc_id", "text_hash").agg(
        F.first("n_words").alias("n_words"),
        F.count_if(F.col("_block") == 0).alias("_copies"),
        F.array_distinct(F.flatten(F.collect_set("hit_words"))).alias("hit_words"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"),
    )
    return merged.select(
        "doc_id", "text_hash", "n_words", F.size("hit_words").cast("bigint").alias("n_hit"),
        "items", "spans",
        F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy"),
    ).drop("_copy")


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
