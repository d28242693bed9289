"""Quality classifier: hashed word n-grams, logistic regression learnt by FTRL-proximal."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.training import labelled_sample

BITS = 18
EPOCHS = 4
CACHED_WORDS = 1_000_000

_MASK = (1 << BITS) - 1
_LETTERS = re.compile(r"[^\W\d_]+")
_RUNS = re.compile(r"(.)\1+", re.DOTALL)


def _shape(word: str) -> str:
    """Case, digits and marks of a word: ``THE!!`` is ``A!``, ``Erst.`` is ``Aa.``."""

    def case(run: re.Match) -> str:
        letters = run[0]
        return "a" if letters.islower() else "A" if letters.isupper() else "Aa"

    return _RUNS.sub(r"\1", re.sub(r"\d+", "9", _LETTERS.sub(case, word)))


class WordIds(dict):
    """Word to its hash (high 32 bits) and the hash of its shape (low 31 bits)."""

    def __missing__(self, word: str) -> int:
        both = (crc32(word.encode()) << 31) | (crc32(_shape(word).encode()) & 0x7FFFFFFF)
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = both
        return both


def _mixed(a: np.ndarray, b: np.ndarray | int, salt: int) -> np.ndarray:
    """Bucket of a pair of hashes."""
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(salt)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)) & np.uint64(_MASK)


def features(text: str | None, ids: WordIds) -> np.ndarray:
    """Buckets of all n-grams of a text, repeats included; empty for a text without words.

    Unigrams and bigrams of words and of word shapes. A word that repeats the one before it, and
    a bigram that the text has had before, have buckets of their own.
    """
    words = (text or "").split()
    if not words:
        return np.empty(0, np.int64)
    both = np.fromiter(map(ids.__getitem__, words), np.uint64, len(words))
    word, shape = both >> np.uint64(31), both & np.uint64(0x7FFFFFFF)
    none = np.zeros(1, np.uint64)
    parts = [_mixed(word, none, 1), _mixed(shape, none, 2)]
    if len(words) > 1:
        pairs = _mixed(word[:-1], word[1:], 3)
        same = word[:-1] == word[1:]
        ordered = np.sort(pairs)
        again = int((ordered[1:] == ordered[:-1]).sum())
        parts += [
            np.where(same, np.uint64(5), pairs), _mixed(shape[:-1], shape[1:], 4),
            np.repeat(np.array([6, 7], np.uint64), [again, len(pairs) - again]),
        ]
    return np.concatenate(parts).view(np.int64)


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float

    def score(self, text: str | None, ids: WordIds) -> float:
        """Sparse dot product of the text's n-gram frequencies with the weights, as a probability."""
        found = features(text, ids)
        x = self.bias + (float(self.weights[found].sum()) * _scale(len(found)) if len(found) else 0)
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def _scale(n: int) -> float:
    return 20.0 / n


def fit_ftrl(
    rows: list[tuple[str, int]],
    epochs: int = EPOCHS,
    alpha: float = 0.3,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.02,
) -> QualityModel:
    """Follow-the-regularised-leader, one update for each document and epoch.

    Without rows of both labels the model scores 0.5 throughout. The same rows in the same order
    give the same model.
    """
    size = _MASK + 2  # the last one is the bias
    z, n = np.zeros(size), np.zeros(size)
    ids = WordIds()
    data = []
    for text, label in rows:
        found, counts = np.unique(features(text, ids), return_counts=True)
        values = counts * _scale(counts.sum()) if len(counts) else counts.astype(float)
        data.append((np.append(found, size - 1), np.append(values, 1.0), label))
    if len({label for _, _, label in data}) < 2:
        return QualityModel(np.zeros(size - 1, np.float32), 0.0)

    def weight(z_part, n_part):
        rate = (beta + np.sqrt(n_part)) / alpha + l2
        return np.where(np.abs(z_part) <= l1, 0.0, -(z_part - np.sign(z_part) * l1) / rate)

    order = np.random.default_rng(11)
    for _ in range(epochs):
        for i in order.permutation(len(data)):
            found, values, label = data[i]
            w = weight(z[found], n[found])
            p = 1 / (1 + np.exp(-np.clip(w @ values, -30, 30)))
            g = (p - label) * values
            sigma = (np.sqrt(n[found] + g * g) - np.sqrt(n[found])) / alpha
            z[found] += g - sigma * w
            n[found] += g * g
    w = weight(z, n)
    return QualityModel(w[:-1].astype(np.float32), float(w[-1]))


def fit(docs: DataFrame, labels: DataFrame, label: str, learnable: Column) -> QualityModel:
    """A model from a bounded sample of labelled rows (see ``training``)."""
    return fit_ftrl(labelled_sample(docs, labels, label, learnable))


def score_documents(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, score`` of every row; texts without words get the bias' score.

    Only ``doc_id`` and ``text`` are read, and only ``text`` has a say in the score. Nothing is
    shuffled; repeated rows repeat.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ids = shared.value, WordIds()
        for batch in batches:
            scores = [own.score(t, ids) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], schema=schema
            )

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(score, "doc_id bigint, score double")
