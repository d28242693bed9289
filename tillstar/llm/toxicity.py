"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.training import labelled_sample, plain_words

#: Words of a window and the step between windows; a text's last window ends with the text.
WINDOW, STEP = 32, 16
HIDDEN = 8
INPUTS = 8
WORD_BITS, CHAR_BITS = 16, 17
GRAMS = (3, 4, 5, 6)
EPOCHS = 6
#: Documents that the log-odds of a bucket start from, as many of each label as on average.
PRIOR = 3.0
BATCH = 128
#: Windows that go through the network at a time, and words whose inputs a worker remembers.
CHUNK = 2_048
CACHED_WORDS = 1_000_000


def _soft(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|): stands in for tanh, and half of it plus a half for the logistic gate."""
    return x / (1 + np.abs(x))


def _soft_slope(y: np.ndarray) -> np.ndarray:
    """Slope of ``_soft`` where it is ``y``."""
    return (1 - np.abs(y)) ** 2


def network_words(text: str | None) -> list[bytes]:
    """Words of a text; a word said many times in a row is said once."""
    words = plain_words(text)
    return words[:1] + [b for a, b in zip(words, words[1:]) if a != b]


def word_bucket(word: bytes) -> int:
    return crc32(word) & ((1 << WORD_BITS) - 1)


def char_buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte n-grams of all words between marks, and each word's number of them."""
    flat = np.frombuffer(b"".join(b"\x01" + w + b"\x02" for w in words), np.uint8).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    ends = np.cumsum(sizes)
    place = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    room = np.repeat(sizes, sizes) - place  # bytes from here to the end of the word
    owner = np.repeat(np.arange(len(words)), sizes)
    buckets, owners = [], []
    rolled = np.zeros(len(flat), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        shifted = np.zeros_like(flat)
        shifted[: len(flat) - n + 1] = flat[n - 1 :]
        rolled = (rolled * np.uint64(0x100000001B3)) ^ (shifted + np.uint64(n))
        if n in GRAMS:
            fits = room >= n
            mixed = rolled[fits] * np.uint64(0x9E3779B97F4A7C15)
            buckets.append(mixed >> np.uint64(64 - CHAR_BITS))
            owners.append(owner[fits])
    bucket = np.concatenate(buckets).astype(np.int64)
    by = np.argsort(np.concatenate(owners), kind="stable")
    return bucket[by], np.bincount(np.concatenate(owners), minlength=len(words))


@dataclass
class Network:
    """Weights of the network. ``words`` and ``chars`` are hashed input tables."""

    words: np.ndarray  # (buckets, INPUTS)
    chars: np.ndarray
    w: np.ndarray  # (2, INPUTS, 3 * HIDDEN): update gate, reset gate, candidate
    u: np.ndarray  # (2, HIDDEN, 3 * HIDDEN)
    b: np.ndarray  # (2, 3 * HIDDEN)
    attend: np.ndarray  # (2 * HIDDEN,)
    out: np.ndarray  # (2 * HIDDEN,)
    bias: np.ndarray  # (1,)
    fitted: bool = True

    NAMES = ("words", "chars", "w", "u", "b", "attend", "out", "bias")

    @staticmethod
    def fresh(seed: int = 5) -> "Network":
        r = np.random.default_rng(seed)

        def some(*shape, scale):
            return (r.standard_normal(shape) * scale).astype(np.float32)

        return Network(
            some(1 << WORD_BITS, INPUTS, scale=0.05), some(1 << CHAR_BITS, INPUTS, scale=0.05),
            some(2, INPUTS, 3 * HIDDEN, scale=0.5), some(2, HIDDEN, 3 * HIDDEN, scale=0.3),
            np.zeros((2, 3 * HIDDEN), np.float32), some(2 * HIDDEN, scale=0.3),
            some(2 * HIDDEN, scale=0.3), np.zeros(1, np.float32),
        )

    def inputs(self, words: list[bytes]) -> np.ndarray:
        """Input of each word: its own row plus the mean of its characters' rows."""
        bucket, counts = char_buckets(words)
        starts = np.cumsum(counts) - counts
        chars = np.add.reduceat(self.chars[bucket], starts, axis=0) / counts[:, None]
        own = self.words[np.fromiter(map(word_bucket, words), np.int64, len(words))]
        return (own + chars).astype(np.float32)

    def forward(self, x: np.ndarray, real: np.ndarray, keep: bool = False):
        """Logits of windows ``x`` (window, word, input); ``real`` marks words that are there."""
        n, steps, _ = x.shape
        h3 = 3 * HIDDEN
        states = np.empty((steps, n, 2 * HIDDEN), np.float32)
        kept = []
        for side in (0, 1):
            gates = x.transpose(1, 0, 2).reshape(steps * n, -1) @ self.w[side] + self.b[side]
            gates = gates.reshape(steps, n, h3)
            h = np.zeros((n, HIDDEN), np.float32)
            columns = slice(side * HIDDEN, (side + 1) * HIDDEN)
            trail = []
            for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
                from_h = h @ self.u[side]
                zr = 0.5 * _soft(gates[t, :, : 2 * HIDDEN] + from_h[:, : 2 * HIDDEN]) + 0.5
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = _soft(gates[t, :, 2 * HIDDEN :] + r * from_h[:, 2 * HIDDEN :])
                new = c + z * (h - c)
                if keep:
                    trail.append((t, h, zr, c, from_h[:, 2 * HIDDEN :]))
                h = new
                states[t, :, columns] = h
            kept.append(trail)
        scores = states @ self.attend  # (steps, window)
        scores = np.where(real.T, scores, np.float32(-1e9))
        scores -= scores.max(axis=0)
        share = np.exp(scores)
        share /= share.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", share, states)
        logit = pooled @ self.out + self.bias[0]
        return (logit, (states, share, pooled, kept)) if keep else logit

    def gradients(self, x: np.ndarray, real: np.ndarray, error: np.ndarray, saved) -> dict:
        """Gradients of a loss whose slope by each logit is ``error``; back through all steps."""
        states, share, pooled, kept = saved
        n, steps, _ = x.shape
        g = {"out": pooled.T @ error, "bias": np.array([error.sum()], np.float32)}
        d_pooled = error[:, None] * self.out
        d_share = np.einsum("nh,tnh->tn", d_pooled, states)
        d_score = share * (d_share - (share * d_share).sum(axis=0))
        g["attend"] = np.einsum("tn,tnh->h", d_score, states)
        d_states = share[:, :, None] * d_pooled + d_score[:, :, None] * self.attend
        g["w"], g["u"], g["b"] = np.zeros_like(self.w), np.zeros_like(self.u), np.zeros_like(self.b)
        d_x = np.zeros_like(x)
        for side in (0, 1):
            d_next = np.zeros((n, HIDDEN), np.float32)
            for t, h, zr, c, from_c in reversed(kept[side]):
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                d = d_states[t, :, side * HIDDEN : (side + 1) * HIDDEN] + d_next
                d_c = d * (1 - z) * _soft_slope(c)
                d_z = d * (h - c) * 0.5 * _soft_slope(2 * z - 1)
                d_r = d_c * from_c * 0.5 * _soft_slope(2 * r - 1)
                d_gates = np.concatenate((d_z, d_r, d_c), axis=1)
                d_from = np.concatenate((d_z, d_r, d_c * r), axis=1)
                g["w"][side] += x[:, t].T @ d_gates
                g["b"][side] += d_gates.sum(axis=0)
                g["u"][side] += h.T @ d_from
                d_x[:, t] += d_gates @ self.w[side].T
                d_next = d * z + d_from @ self.u[side].T
        g["x"] = d_x * real[:, :, None]
        return g


def window_starts(words: int) -> list[int]:
    """Where the overlapping windows start; a short or empty text has one window."""
    last = max(0, words - WINDOW)
    return [*range(0, last, STEP), last]


def _windows(counts: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts laid end to end: word numbers of all windows, which are real, windows per text."""
    starts, per_text, ends, offset = [], [], [], 0
    for n in counts:
        own = window_starts(n)
        starts += [offset + s for s in own]
        ends += [offset + n] * len(own)
        per_text.append(len(own))
        offset += n
    places = np.array(starts, np.int64)[:, None] + np.arange(WINDOW)
    real = places < np.array(ends, np.int64)[:, None]
    return np.where(real, places, offset), real, np.array(per_text, np.int64)


class Scorer:
    """Scores texts; remembers the inputs of words it has met."""

    def __init__(self, network: Network):
        self.network = network
        self.known: dict[bytes, int] = {}
        self.table = np.zeros((1 << 16, INPUTS), np.float32)

    def _rows(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        known = self.known
        new = [w for w in dict.fromkeys(words) if w not in known]
        if new:
            start = len(known)
            while start + len(new) > len(self.table):
                self.table = np.concatenate((self.table, np.zeros_like(self.table)))
            self.table[start : start + len(new)] = self.network.inputs(new)
            known.update(zip(new, range(start, start + len(new))))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def window_logits(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Logits of all windows of texts given as words, and the number of windows of each."""
        rows = self._rows([w for words in texts for w in words])
        places, real, per_text = _windows([len(words) for words in texts])
        vectors = np.concatenate((self.table[rows], np.zeros((1, INPUTS), np.float32)))
        real[:, 0] = True  # an empty text attends to one empty word
        found = [
            self.network.forward(vectors[places[i : i + CHUNK]], real[i : i + CHUNK])
            for i in range(0, len(places), CHUNK)
        ]
        return np.concatenate(found), per_text

    def logits(self, texts: list[str | None]) -> np.ndarray:
        """The largest logit of any window of each text."""
        if not texts:
            return np.empty(0)
        found, per_text = self.window_logits([network_words(t) for t in texts])
        return np.maximum.reduceat(found, np.cumsum(per_text) - per_text)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts).astype(np.float64), -30, 30)))


def _log_odds(rows: list[tuple[list[bytes], int]], size: int, buckets) -> np.ndarray:
    """Smoothed log-odds of label 1 for documents that have a bucket, over the learnt rows."""
    seen = np.zeros((2, size))
    for words, label in rows:
        if words:
            seen[label, np.unique(buckets(list(dict.fromkeys(words))))] += 1
    share = np.array([sum(label == k for _, label in rows) for k in (0, 1)], float) / len(rows)
    rate = (seen + PRIOR * share[:, None]) / share[:, None]
    odds = np.log(rate[1] / rate[0])
    return np.where(seen.sum(axis=0) > 0, odds, 0.0).astype(np.float32)


def _summed(rows: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct row numbers and the sums of their gradients."""
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    firsts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    return ordered[firsts], np.add.reduceat(d[order], firsts, axis=0)


class _Trainer:
    """Adam for the network, a step by its own past gradients for each row of the input tables."""

    def __init__(self, network: Network):
        self.network, self.steps = network, 0
        self.dense = [n for n in Network.NAMES if n not in ("words", "chars")]
        self.first = {n: np.zeros_like(getattr(network, n)) for n in self.dense}
        self.second = {n: np.zeros_like(getattr(network, n)) for n in self.dense}
        self.past = {
            n: np.full(len(getattr(network, n)), 1e-6, np.float32) for n in ("words", "chars")
        }

    def epoch(self, examples: list[tuple[list[bytes], int]], random: np.random.Generator) -> None:
        network = self.network
        distinct = list(dict.fromkeys(w for words, _ in examples for w in words))
        number = {w: i for i, w in enumerate(distinct)}
        buckets, counts = char_buckets(distinct)
        firsts = np.cumsum(counts) - counts
        own = np.fromiter(map(word_bucket, distinct), np.int64, len(distinct))
        order = random.permutation(len(examples))
        for at in range(0, len(order), BATCH):
            pick = [examples[i] for i in order[at : at + BATCH]]
            places = np.zeros((len(pick), WINDOW), np.int64)
            real = np.zeros((len(pick), WINDOW), bool)
            for i, (words, _) in enumerate(pick):
                places[i, : len(words)] = [number[w] for w in words]
                real[i, : len(words)] = True
            labels = np.array([label for _, label in pick], np.float32)
            used, inverse = np.unique(places, return_inverse=True)
            inverse = inverse.reshape(places.shape)
            sizes = counts[used]
            ends = np.cumsum(sizes)
            flat = buckets[np.arange(ends[-1]) + np.repeat(firsts[used] - ends + sizes, sizes)]
            chars = np.add.reduceat(network.chars[flat], ends - sizes, axis=0)
            vectors = network.words[own[used]] + chars / sizes[:, None]
            x = vectors[inverse].astype(np.float32) * real[:, :, None]
            attended = real.copy()
            attended[:, 0] = True
            logit, saved = network.forward(x, attended, keep=True)
            p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            error = ((p - labels) / len(pick)).astype(np.float32)
            g = network.gradients(x, real, error, saved)
            self.steps += 1
            rate = 0.02 * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
            for n in self.dense:
                self.first[n] = 0.9 * self.first[n] + 0.1 * g[n]
                self.second[n] = 0.99 * self.second[n] + 0.01 * g[n] ** 2
                getattr(network, n)[...] -= rate * self.first[n] / (np.sqrt(self.second[n]) + 1e-7)
            _, d_word = _summed(inverse.ravel(), g["x"].reshape(-1, INPUTS))
            for n, rows, d in (
                ("words", own[used], d_word),
                ("chars", flat, np.repeat(d_word / sizes[:, None], sizes, axis=0)),
            ):
                at_rows, sums = _summed(rows, d)
                self.past[n][at_rows] += (sums**2).mean(axis=1)
                scale = 0.05 / np.sqrt(self.past[n][at_rows])
                getattr(network, n)[at_rows] -= scale[:, None] * sums


def train(rows: list[tuple[str, int]], epochs: int = EPOCHS, seed: int = 5) -> Network:
    """Fit the network on labelled texts; without both labels it scores 0.5 throughout.

    The first input of the tables starts as log-odds of their buckets. A document of label 1 need
    not be toxic in all its windows, so it teaches with the window that these odds find most
    telling, one of label 0 with that and one by chance. Half-way, each document of label 0 adds
    the window that the network finds most toxic. Adam, log loss.
    """
    network = Network.fresh(seed)
    if len({label for _, label in rows}) < 2:
        network.out[:] = 0
        network.fitted = False
        return network
    split = [(network_words(text), label) for text, label in rows]
    network.words[:, 0] = _log_odds(
        split, 1 << WORD_BITS, lambda ws: np.fromiter(map(word_bucket, ws), np.int64, len(ws))
    ) / 2
    network.chars[:, 0] = _log_odds(split, 1 << CHAR_BITS, lambda ws: char_buckets(ws)[0])

    random = np.random.default_rng(seed)
    examples: list[tuple[list[bytes], int]] = []
    for words, label in split:
        starts = window_starts(len(words))
        if len(starts) > 2:
            distinct = list(dict.fromkeys(words))
            weight = dict(zip(distinct, network.inputs(distinct)[:, 0].tolist()))
            best = [max(weight[w] for w in words[s : s + WINDOW]) for s in starts]
            ranked = np.argsort(best)[::-1]
            chance = [] if label else [starts[random.integers(len(starts))]]
            starts = [starts[ranked[0]], *chance]
        examples += [(words[s : s + WINDOW], label) for s in starts]
    trainer = _Trainer(network)
    for epoch in range(epochs):
        if epoch == epochs // 2:
            examples += _most_toxic([words for words, label in split if not label], network)
        trainer.epoch(examples, random)
    _centre(network, rows)
    return network


def _most_toxic(clean: list[list[bytes]], network: Network) -> list[tuple[list[bytes], int]]:
    """Of each clean text the window that the network scores highest, as an example of label 0."""
    scorer, out = Scorer(network), []
    for i in range(0, len(clean), 100):
        group = clean[i : i + 100]
        logits, per_text = scorer.window_logits(group)
        firsts = np.cumsum(per_text) - per_text
        for words, first, n in zip(group, firsts, per_text):
            start = window_starts(len(words))[int(np.argmax(logits[first : first + n]))]
            out.append((words[start : start + WINDOW], 0))
    return out


def _centre(network: Network, rows: list[tuple[str, int]]) -> None:
    """Move the bias so that a score of 0.5 parts the learnt documents best by whole texts."""
    labels = np.array([label for _, label in rows])
    scorer = Scorer(network)
    logits = np.concatenate(
        [scorer.logits([t for t, _ in rows[i : i + 200]]) for i in range(0, len(rows), 200)]
    )
    order = np.argsort(logits, kind="stable")
    # errors if the first i documents in order of their logits count as label 0
    wrong = np.concatenate(([0], np.cumsum(labels[order]))) + np.concatenate(
        ([0], np.cumsum((1 - labels[order])[::-1]))
    )[::-1]
    best = np.flatnonzero(wrong == wrong.min())
    cut = int(best[len(best) // 2])
    sorted_logits = logits[order]
    low = sorted_logits[cut - 1] if cut > 0 else sorted_logits[0] - 2
    high = sorted_logits[cut] if cut < len(order) else sorted_logits[-1] + 2
    network.bias -= np.float32((low + high) / 2)


def fit(docs: DataFrame, labels: DataFrame, label: str, learnable: Column) -> Network:
    """A network from a bounded sample of labelled rows (see ``training``)."""
    return train(labelled_sample(docs, labels, label, learnable))


def score_documents(docs: DataFrame, network: Network) -> DataFrame:
    """``doc_id, text_hash, score`` of every row: the most toxic of all overlapping windows.

    Only ``doc_id`` and ``text`` are read, and only ``text`` has a say in the score. Null texts
    and texts without words have one empty window. Nothing is shuffled; repeated rows repeat. The
    network has a fixed size, so what is broadcast does not grow with the data.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("score", pa.float64())]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            parts = [scorer.scores(part) for part in _portions(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"),
                 pa.array(np.concatenate(parts) if parts else [], pa.float64())],
                schema=schema,
            )

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(score, "doc_id bigint, text_hash bigint, score double")


def _portions(texts: list[str | None], chars: int = 1_000_000) -> Iterator[list[str | None]]:
    """Texts in groups of about ``chars`` code points, to bound what is laid end to end."""
    group: list[str | None] = []
    size = 0
    for text in texts:
        group.append(text)
        size += len(text or "")
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group
