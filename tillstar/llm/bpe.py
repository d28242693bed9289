"""Byte-level BPE with a queue of merge ranks: a bucket per rank under a hierarchy of bitmaps."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Pre-tokens whose ids a Python worker remembers; then it starts anew.
CACHED_PIECES = 1_000_000
CACHED_BYTES = 48

ENCODED = (
    "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, is_whole boolean"
)

_codecs: dict[tuple[bytes, str], "Codec"] = {}


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and number."""
    pairs = (line.split() for line in data.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class _Pieces(dict):
    """Ids of pre-tokens, worked out when first asked for."""

    def __init__(self, codec: "Codec"):
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode()
        ids = np.array(self.codec.merge(raw), "<u4").tobytes()
        if len(raw) <= CACHED_BYTES:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids


def ascii_pattern(pattern: str) -> str:
    """The pattern with the letter and number classes spelt out for ASCII texts."""
    classes = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9"}
    inside = False

    def spelt(part: re.Match) -> str:
        nonlocal inside
        if part[0] in "[]":
            inside = part[0] == "["
        found = classes.get(part[0])
        return part[0] if found is None else found if inside else f"[{found}]"

    return re.sub(r"\\p\{.\}|\\.|[\[\]]", spelt, pattern)


class Codec:
    """Encodes and decodes with a rank table; pieces of the pattern are merged separately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.find_any = regex.compile(pattern).findall
        # Python's own engine is quicker, and its classes are the same on ASCII texts.
        self.find_ascii = re.compile(ascii_pattern(pattern), re.ASCII).findall
        self.low = [0] * ((max(ranks.values(), default=0) >> 8) + 1)
        by_rank = sorted((rank, token) for token, rank in ranks.items())
        self.flat = np.frombuffer(b"".join(token for _, token in by_rank), np.uint8)
        size = max(ranks.values(), default=-1) + 1
        self.sizes, self.starts = np.zeros(size, np.int64), np.zeros(size, np.int64)
        places = [rank for rank, _ in by_rank]
        self.sizes[places] = [len(token) for _, token in by_rank]
        self.starts[places] = np.cumsum(self.sizes[places]) - self.sizes[places]
        self.pieces = _Pieces(self)

    def merge(self, raw: bytes) -> list[int]:
        """Ids of one pre-token: the lowest-ranked neighbouring pair is merged until none is left.

        The queue holds merge positions, lowest rank first, leftmost first within a rank. A bit of
        a word of ``low`` is a rank with entries, a bit of ``top`` a word that is not zero, so two
        find-first-sets give the next rank. A bucket is a heap of positions. An entry is stale, and
        skipped, if the pair at its position has another rank by now. The queue is written out
        here because it is the inner loop; ``low`` ends as zeros and serves the next pre-token.
        """
        ranks, low = self.ranks, self.low
        whole = ranks.get(raw)
        if whole is not None:
            return [whole]
        n = len(raw)
        after = list(range(1, n + 2))  # where the next symbol starts; n is the end
        before = list(range(-1, n))
        pair = [ranks.get(raw[i : i + 2], -1) for i in range(n - 1)]
        buckets: dict[int, list[int]] = {}
        top, new = 0, list(enumerate(pair))
        pair += (-1, -1)
        while True:
            for i, rank in new:
                if rank < 0:
                    continue
                if rank in buckets:
                    heappush(buckets[rank], i)
                else:
                    buckets[rank] = [i]
                    low[rank >> 8] |= 1 << (rank & 255)
                    top |= 1 << (rank >> 8)
            if not top:
                break
            word = (top & -top).bit_length() - 1
            bits = low[word]
            rank = word << 8 | (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                low[word] = bits = bits & (bits - 1)
                if not bits:
                    top &= top - 1
            new = ()
            if pair[i] != rank:
                continue
            gone = after[i]
            after[i] = end = after[gone]
            before[end] = i
            pair[gone] = -1
            pair[i] = right = ranks.get(raw[i : after[end]], -1) if end < n else -1
            left = before[i]
            if left < 0:
                new = ((i, right),)
            else:
                pair[left] = rank = ranks.get(raw[left:end], -1)
                new = ((left, rank), (i, right))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[raw[i : after[i]]])
            i = after[i]
        return ids

    def find(self, text: str) -> list[str]:
        return self.find_ascii(text) if text.isascii() else self.find_any(text)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        pieces = self.pieces
        return b"".join([pieces[p] for p in self.find(text)])

    def decode(self, ids: bytes) -> bytes:
        which = np.frombuffer(ids, "<u4")
        sizes = self.sizes[which]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        places = np.arange(total) + np.repeat(self.starts[which] - ends + sizes, sizes)
        return self.flat[places].tobytes()


def _codec(ranks: Broadcast, pattern: str) -> Codec:
    """The codec of this Python worker; a worker keeps the last one with its remembered pieces."""
    key = (hashlib.sha256(ranks.value).digest(), pattern)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(read_ranks(ranks.value), pattern)
    return _codecs[key]


def broadcast_ranks(spark: SparkSession, path: str) -> Broadcast:
    """The rank file as it is: one vocabulary, so its size does not depend on the texts."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_documents(docs: DataFrame, ranks: Broadcast, pattern: str) -> DataFrame:
    """``doc_id, ids`` of every text; ids are little-endian unsigned 32-bit integers in one binary.

    Null and empty texts have no ids. Rows stay as they are: repeated rows repeat.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, pattern)
        for batch in batches:
            ids = [codec.encode(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary())], schema=schema
            )

    return _texts(docs).mapInArrow(encode, "doc_id bigint, ids binary")


def decode_documents(encoded: DataFrame, ranks: Broadcast, pattern: str) -> DataFrame:
    """``doc_id, bytes`` of every row of ``doc_id, ids``; null ids give no bytes."""
    schema = pa.schema([("doc_id", pa.int64()), ("bytes", pa.binary())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, pattern)
        for batch in batches:
            raw = [codec.decode(i or b"") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(raw, pa.binary())], schema=schema
            )

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id bigint, bytes binary")


def round_trip(docs: DataFrame, ranks: Broadcast, pattern: str) -> DataFrame:
    """Encode and decode every text in one pass; digests of both instead of the data.

    ``is_whole`` tells if the decoded bytes are the text's. Nothing is shuffled.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
         ("decoded_sha256", pa.string()), ("is_whole", pa.bool_())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks, pattern)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                ids = codec.encode(text or "")
                raw = codec.decode(ids)
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                             hashlib.sha256(raw).hexdigest(), raw == (text or "").encode()))
            columns = list(zip(*rows)) if rows else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:])]],
                schema=schema,
            )

    return _texts(docs).mapInArrow(run, ENCODED)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
