"""Fill-in-the-middle texts, cut at unit bounds that a compressed boundary set finds by rank."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 16
ARRAY_MOST = 4096
BATCH_CHARS = 8_000_000


@dataclass(frozen=True)
class ArrayContainer:
    """Sorted offsets inside a block."""

    offsets: np.ndarray

    def select(self, rank: int) -> int:
        return int(self.offsets[rank])


@dataclass(frozen=True)
class BitmapContainer:
    """One bit for each offset of a block, with the number of set bits before each word."""

    words: np.ndarray
    before: np.ndarray

    def select(self, rank: int) -> int:
        at = int(np.searchsorted(self.before, rank, side="right")) - 1
        word = int(self.words[at])
        for _ in range(rank - int(self.before[at])):
            word &= word - 1  # take out the lowest set bit
        return at * 64 + (word & -word).bit_length() - 1


@dataclass(frozen=True)
class RunContainer:
    """First offsets of runs of consecutive offsets, with the number of offsets before each run."""

    starts: np.ndarray
    before: np.ndarray

    def select(self, rank: int) -> int:
        run = int(np.searchsorted(self.before, rank, side="right")) - 1
        return int(self.starts[run]) + rank - int(self.before[run])


def _container(marks: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest of the three forms for the marks of a block."""
    offsets = np.flatnonzero(marks)
    first = np.ones(len(offsets), bool)
    first[1:] = np.diff(offsets) > 1
    runs = np.flatnonzero(first)
    if 4 * len(runs) < min(2 * len(offsets), BLOCK // 8):
        return RunContainer(offsets[runs].astype(np.uint16), runs.astype(np.int32))
    if len(offsets) <= ARRAY_MOST:
        return ArrayContainer(offsets.astype(np.uint16))
    bits = np.zeros(BLOCK, np.uint8)
    bits[: len(marks)] = marks
    packed = np.packbits(bits, bitorder="little")
    counts = np.bitwise_count(packed.view("<u8"))
    return BitmapContainer(packed.view("<u8"), np.cumsum(counts, dtype=np.int64) - counts)


class BoundarySet:
    """The set offsets of ``marks`` in blocks of 65,536: arrays, bitmaps or runs.

    Cumulative cardinalities lead from a rank to its container; the container does the rest.
    """

    def __init__(self, marks: np.ndarray):
        found = [
            (start, _container(marks[start : start + BLOCK]),
             int(np.count_nonzero(marks[start : start + BLOCK])))
            for start in range(0, len(marks), BLOCK)
        ]
        held = [f for f in found if f[2]]
        self.starts = [start for start, _, _ in held]
        self.containers = [container for _, container, _ in held]
        self.before = np.cumsum([0] + [n for *_, n in held])

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, rank: int) -> int:
        """The offset of that rank, from 0."""
        if not 0 <= rank < len(self):
            raise IndexError(rank)
        at = int(np.searchsorted(self.before, rank, side="right")) - 1
        return self.starts[at] + self.containers[at].select(rank - int(self.before[at]))


def unit_bounds(text: str) -> BoundarySet:
    """Where units begin or end: 0, and the end of each run of ASCII letters and each other code point."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    folded = points | 32
    letter = (folded >= ord("a")) & (folded <= ord("z"))
    marks = np.ones(len(points) + 1, bool)
    marks[1:-1] = ~(letter[:-1] & letter[1:])
    return BoundarySet(marks)


@dataclass(frozen=True)
class Infill:
    """What to cut and how to write it: marks, shares of plain and of suffix-first texts, a seed."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    formed_pct: int = 90
    suffix_first_pct: int = 20
    seed: int = 1

    def __post_init__(self):
        marks = [self.prefix, self.suffix, self.middle]
        if len(set(marks)) < 3 or not all(
            len(m) > 1 and all(m[0] not in other[1:] for other in marks) for m in marks
        ):
            raise ValueError("marks must differ, and none may begin inside another or inside itself")

    def dice(self, doc_id: int | None) -> list[int]:
        """Four numbers of 32 bits from seed and id; a null id counts as an empty one."""
        digest = hashlib.sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).digest()
        return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]

    def write(self, doc_id: int | None, text: str) -> tuple[int, str, int | None, int | None, str]:
        """Units, form, code points of prefix and of middle, and the text as written."""
        bounds = unit_bounds(text)
        units = len(bounds) - 1
        h1, h2, h3, h4 = self.dice(doc_id)
        marked = any(m in text for m in (self.prefix, self.suffix, self.middle))
        if not text or marked or h3 % 100 >= self.formed_pct:
            return units, "plain", None, None, text
        a, b = sorted((bounds.select(h1 % (units + 1)), bounds.select(h2 % (units + 1))))
        before, within, after = text[:a], text[a:b], text[b:]
        if h4 % 100 < self.suffix_first_pct:
            parts = [self.suffix, after, self.prefix, before, self.middle, within]
            form = "spm"
        else:
            parts = [self.prefix, before, self.suffix, after, self.middle, within]
            form = "psm"
        return units, form, a, b - a, "".join(parts)


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_units", pa.int64()), ("form", pa.string()),
     ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]
)


def fill_in_middle(docs: DataFrame, how: Infill = Infill()) -> DataFrame:
    """``doc_id, n_units, form, prefix_chars, middle_chars, output`` of every row.

    A unit is a run of ASCII letters or any other code point. Both cuts are drawn from the id, so
    rows of one id and text come out alike, and equal texts of different ids are cut apart. Null
    counts as the empty text, which stays plain with no units; a null id draws as an empty one.
    Texts that hold a mark stay plain. Only ``doc_id`` and ``text`` are read. Texts of any length
    are cut whole, one at a time; nothing is shuffled, and a lost task is done again alike.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, chars = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                doc_id, text = doc_id.as_py(), text.as_py() or ""
                rows.append((doc_id, *how.write(doc_id, text)))
                chars += len(text)
                if chars >= BATCH_CHARS:
                    yield _batch(rows)
                    rows, chars = [], 0
        if rows:
            yield _batch(rows)

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(
        run, "doc_id bigint, n_units bigint, form string, prefix_chars bigint, "
        "middle_chars bigint, output string",
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA
    )


def restored(output: Column, form: Column, how: Infill = Infill()) -> Column:
    """The text again, from what was written and its form alone.

    The text holds no mark, so the first find of each is the mark itself.
    """

    def split(text: Column, mark: str) -> tuple[Column, Column]:
        head = F.substring_index(text, mark, 1)
        return head, F.substr(text, F.char_length(head) + len(mark) + 1)

    _, rest = split(output, how.prefix)
    before, rest = split(rest, how.suffix)
    after, within = split(rest, how.middle)
    psm = F.concat(before, within, after)
    _, rest = split(output, how.suffix)
    after, rest = split(rest, how.prefix)
    before, within = split(rest, how.middle)
    spm = F.concat(before, within, after)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
