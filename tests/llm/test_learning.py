"""BPE against the public library; the classifiers by held-out accuracy; the pipeline."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from text_cases import ODD
from tillstar.llm import bpe, pipeline, quality, toxicity
from tillstar.llm.catalog import QUERIES
from tillstar.llm.oracles import ORACLES
from tillstar.llm.training import fold, labelled_sample

SMALL = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
here = pytest.mark.skipif(not Path(SMALL).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def codec():
    with open(RANKS, "rb") as f:
        return bpe.Codec(bpe.read_ranks(f.read()), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def public(codec):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={}
    )


def test_ids_are_the_librarys(codec, public):
    r = random.Random(1)
    texts = [t or "" for _, t in ODD] + ["it's we'll <|endoftext|>  \n\n  end ", "\x1c\x85​ "]
    texts += ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(0x20000)])) for _ in range(200))
              .encode("utf-8", "ignore").decode() for _ in range(40)]
    texts += ["a" * 5000, "ab" * 3000, "".join(r.choice("abcdefgh") for _ in range(4000))]
    for text in texts:
        ids = codec.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == public.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_encode_and_decode_documents(spark, odd, empty):
    ranks = bpe.broadcast_ranks(spark, RANKS)
    encoded = bpe.encode_documents(odd, ranks, public_tokenizers.PATTERN)
    decoded = bpe.decode_documents(encoded, ranks, public_tokenizers.PATTERN).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted([(i, (t or "").encode()) for i, t in ODD], key=key)
    assert sorted([(r.doc_id, bytes(r.bytes)) for r in decoded], key=key) == want
    assert bpe.round_trip(odd, ranks, public_tokenizers.PATTERN).filter("NOT is_whole").count() == 0
    assert bpe.round_trip(empty, ranks, public_tokenizers.PATTERN).collect() == []


# --- classifiers ---

PLAIN = "the of and river stone walks green under nine bright paper cloud".split()


def labelled(seed, n=260, junk=False):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        text = [r.choice(PLAIN) for _ in range(r.randint(20, 120))]
        bad = i % 4 == 0
        if bad:
            for _ in range(4):
                text[r.randrange(len(text))] = "vile" + r.choice(["ness", "ry", "ling", "dom", "ster"])
            text = [w.upper() + "!!" if junk else w for w in text]
        rows.append((i, " ".join(text), int(bad)))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = labelled(3)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id bigint, text string, label string")
    labels = spark.createDataFrame(
        [(i, y, 1 - y) for i, _, y in rows] + [(None, 1, 1), (5, None, 1), (9999, 1, 0)],
        "doc_id bigint, toxic int, quality int",
    )
    return docs, labels, {i: y for i, _, y in rows}


def test_toxicity_on_held_out_texts(tables, odd, empty):
    docs, labels, truth = tables
    network = toxicity.fit(docs, labels, "toxic", fold(F.col("doc_id"), 5) != 0)
    scored = toxicity.score_documents(docs, network).join(
        docs.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held")), "doc_id"
    ).filter("held").collect()
    assert len(scored) > 30
    assert np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in scored]) > 0.95
    assert toxicity.score_documents(odd, network).filter("score BETWEEN 0 AND 1").count() == len(ODD)
    assert toxicity.score_documents(empty, network).collect() == []


def test_gradients_are_slopes():
    network = toxicity.Network.fresh(2)
    for name in toxicity.Network.NAMES:
        setattr(network, name, getattr(network, name).astype(np.float64))
    r = np.random.default_rng(3)
    x, real = r.standard_normal((4, 6, toxicity.INPUTS)), np.ones((4, 6), bool)
    real[0, 4:] = False
    x *= real[:, :, None]
    weight = r.standard_normal(4)

    def loss():
        return float(network.forward(x, real) @ weight)

    _, saved = network.forward(x, real, keep=True)
    saved = (saved[0].astype(np.float64), *saved[1:])
    g = network.gradients(x, real, weight, saved)
    for name in ("w", "u", "b", "attend", "out", "bias"):
        values = getattr(network, name)
        where = tuple(r.integers(s) for s in values.shape)
        old, values[where] = values[where], values[where] + 1e-2
        up = loss()
        values[where] = old - 1e-2
        down = loss()
        values[where] = old
        assert g[name][where] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=2e-2)


def test_all_windows_overlap_and_cover_the_text():
    for n in (0, 1, 32, 33, 47, 48, 49, 500):
        starts = toxicity.window_starts(n)
        covered = {i for s in starts for i in range(s, s + toxicity.WINDOW)}
        assert covered >= set(range(n))
        assert all(b - a <= toxicity.STEP for a, b in zip(starts, starts[1:]))


def test_quality_on_held_out_texts(spark, tables, odd, empty):
    _, labels, truth = tables
    docs = spark.createDataFrame(
        [(i, t) for i, t, _ in labelled(3, junk=True)], "doc_id bigint, text string"
    )
    model = quality.fit(docs, labels, "quality", fold(F.col("doc_id"), 3) != 1)
    scored = quality.score_documents(docs, model).join(
        docs.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held")), "doc_id"
    ).filter("held").collect()
    assert np.mean([(r.score >= 0.5) == (not truth[r.doc_id]) for r in scored]) > 0.9
    assert quality.score_documents(odd, model).filter("score BETWEEN 0 AND 1").count() == len(ODD)
    assert quality.score_documents(empty, model).collect() == []


def test_nothing_to_learn_from(tables, empty):
    docs, labels, _ = tables
    none = labels.filter("doc_id = 1")
    scores = quality.score_documents(docs, quality.fit(docs, none, "quality", F.lit(True)))
    assert scores.filter("score <> 0.5").count() == 0
    scores = toxicity.score_documents(docs, toxicity.fit(docs, none.limit(0), "toxic", F.lit(True)))
    assert scores.filter("score <> 0.5").count() == 0


def test_samples_are_bounded(tables):
    docs, labels, _ = tables
    assert len(labelled_sample(docs, labels, "toxic", F.lit(True), rows=30)) == 30
    few = labelled_sample(docs, labels, "toxic", F.lit(True), chars=2_000)
    assert few and sum(len(t) for t, _ in few) <= 2_000


def test_fold_is_crc32_of_the_id_as_text(spark):
    import zlib

    rows = spark.range(-3, 50).select("id", fold(F.col("id"), 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


# --- registered queries and the pipeline ---


def test_one_query_for_each_operator():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@here
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    import duckdb

    import check

    db = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages", "labels"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df, want = QUERIES[name](spark, SMALL), db.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert check.rows(df.collect(), df.columns) == check.rows(want.fetchall(), want.columns)


@here
def test_pipeline_keeps_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "byte_bpe"
    ]
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = pipeline.written(stage(spark, kept, SMALL), "test-stage")
        assert kept.columns == docs.columns
    count = kept.count()
    assert 0 < count < docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, kept, SMALL).filter("is_whole").count() == count


def test_stages_take_odd_documents(spark, odd, empty):
    for name, stage in corpus_pipeline.STAGES:
        kept, none = stage(spark, odd, SMALL), stage(spark, empty, SMALL)
        if name != "byte_bpe":
            assert kept.columns == none.columns == odd.columns
        else:
            assert kept.filter("NOT is_whole").count() == 0 and kept.count() == odd.count()
        assert none.count() == 0
    # of equal texts and of texts without words one row stays; of several without an id each by its text
    ids = sorted(r.doc_id or 0 for r in pipeline.simhash_dedup(spark, odd, SMALL).collect())
    assert ids == [0, 1, 4, 6, 7, 8, 9]
