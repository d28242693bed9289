"""The corpus pipeline against plain Python, and its stages on rows that share an id or have none."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from test_learning import RANKS, labelled
from test_matching import brute_print, joined, words
from test_texts import brute_lines
from tillstar.llm import bpe, pipeline, toxicity
from tillstar.llm.training import fold, labelled_sample

CLEAN = "a calm walk along the river bank under nine old stone arches"
OTHER = "paper boats drift past the mill while two herons wait in shallow water"
LEAK = "the quick brown fox jumps over the lazy dog and then some more words"
VILE = " ".join(["vileness vilery green vilester vileling the vildom viledom"] * 3)


@pytest.fixture(scope="module")
def tables_at(spark, tmp_path_factory):
    """A folder with labels and a benchmark, and the labelled documents."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    rows = labelled(3)
    labels = [(i, y, 1 - y) for i, _, y in rows]
    spark.createDataFrame(labels, "doc_id bigint, toxic int, quality int").write.parquet(
        f"{folder}/labels.parquet"
    )
    spark.createDataFrame([(1, LEAK), (None, None)], "item_id bigint, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    return folder, [(i, t) for i, t, _ in rows]


def texts(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_simhash_judges_each_row(spark, docs):
    rows = [(None, CLEAN), (None, OTHER), (None, LEAK), (3, LEAK), (5, CLEAN), (5, VILE), (5, VILE)]
    kept = texts(pipeline.simhash_dedup(spark, docs(*rows), ""))
    assert kept == Counter([(None, OTHER), (3, LEAK), (5, CLEAN), (5, VILE)])


def test_decontamination_judges_each_row(spark, docs, tables_at):
    rows = [(None, CLEAN), (None, LEAK), (None, None), (4, LEAK), (4, OTHER), (4, OTHER)]
    kept = texts(pipeline.decontamination(spark, docs(*rows), tables_at[0]))
    assert kept == Counter([(None, CLEAN), (None, None), (4, OTHER), (4, OTHER)])


def test_toxicity_judges_each_row(spark, docs, tables_at):
    folder, learnt = tables_at
    rows = [(None, CLEAN), (None, VILE), (700, VILE), (700, OTHER), (700, OTHER)]
    kept = texts(pipeline.toxicity_filter(spark, docs(*learnt, *rows), folder))
    assert {r: n for r, n in kept.items() if r[0] in (None, 700)} == {(None, CLEAN): 1, (700, OTHER): 2}


def test_toxicity_without_labels_keeps_all(spark, docs, tables_at, tmp_path):
    folder, _ = tables_at
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(1, CLEAN), (None, VILE), (2, None)]
    assert texts(pipeline.toxicity_filter(spark, docs(*rows), str(tmp_path))) == Counter(rows)


def test_samples_pass_over_huge_texts(spark):
    rows = [(i, "x" * (5_000 if i in (0, 1) else 10), i % 2) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    labels = frame.select("doc_id", "toxic")
    sample = labelled_sample(frame, labels, "toxic", F.lit(True), chars=1_000)
    assert Counter(sample) == Counter((t, y) for _, t, y in rows if len(t) == 10)
    tight = labelled_sample(frame, labels, "toxic", F.lit(True), chars=60)
    assert Counter(y for _, y in tight) == {0: 4, 1: 2}
    # a label whose least text exceeds its share may have what the other leaves
    one = frame.filter("doc_id IN (1, 2)")
    assert Counter(y for _, y in labelled_sample(one, labels, "toxic", F.lit(True), chars=5_010)) == {0: 1, 1: 1}
    assert len(labelled_sample(one, labels, "toxic", F.lit(True), chars=5_009)) == 1


# --- the whole pipeline against plain Python ---


def brute_run(rows, network, items, ranks):
    """The five stages; ``network`` gives the scores, None keeps all."""
    if network is not None:
        scores = toxicity.Scorer(network).scores([t for _, t in rows])
        rows = [r for r, s in zip(rows, scores) if s < 0.5]
    rows = [(i, kept) for (i, _, _, kept), n in brute_lines(rows, 10).items() for _ in range(n)]
    prints = [brute_print(t) for _, t in rows]
    near = [(a, b) for a in set(prints) for b in set(prints) if a < b and (a ^ b).bit_count() <= 4]
    group = joined(near)
    least = {}
    for (i, t), p in zip(rows, prints):
        best = least.setdefault(group.get(p, p), (i, t))
        if (i is None, i or 0) < (best[0] is None, best[0] or 0):
            least[group.get(p, p)] = (i, t)
    out = Counter()
    windows = [(w[j : j + min(10, len(w))]) for w in map(words, items) if w
               for j in range(max(1, len(w) - 9))]
    for i, t in least.values():
        own = words(t)
        if not any(own[j : j + len(w)] == w for w in windows for j in range(len(own))):
            ids = ranks.encode_ordinary(t)
            raw = np.array(ids, "<u4").tobytes()
            out[i, len(ids), hashlib.sha256(raw).hexdigest(), True] += 1
    return out


@pytest.mark.parametrize("case", ["labels", "no labels", "no documents"])
def test_run_is_the_five_stages(spark, tables_at, tmp_path, case):
    folder, learnt = tables_at
    common = "A line that ten documents have"
    rows = [] if case == "no documents" else learnt[:60] + [
        (None, None), (None, CLEAN), (None, OTHER + " by the sea"), (None, VILE), (None, LEAK),
        (700, VILE), (700, OTHER), (700, OTHER), (701, CLEAN), (702, LEAK), (703, ""), (704, None),
    ] + [(800 + i, f"{common}\n{t}") for i, (_, t) in enumerate(learnt[60:75])]
    docs = spark.createDataFrame(
        [(i, t, "x", "s", None if t is None else len(t)) for i, t in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    if case != "labels":
        labels = labels.limit(0)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    network = toxicity.fit(docs, labels, "toxic", fold(F.col("doc_id"), 5) != 0)
    with open(RANKS, "rb") as f:
        ranks = bpe.read_ranks(f.read())
    public = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    want = brute_run(rows, network if case == "labels" else None, [LEAK], public)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.is_whole) for r in got) == want
    assert bool(want) == bool(rows)
