"""SimHash near-dedup by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.components import components
from tillstar.llm.tables import written

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Shingles whose bits are counted at a time.
CHUNK = 65_536

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits: each is set if it is in over half of the hashes of the text's shingles."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(flat[a:b], SEED) for a, b in spans], "<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        part = hashes[i : i + CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_hash, fp`` of every row; ``fp`` has the 64 bits as a signed long."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            bits = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(bits)], schema=schema
            )

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    ).mapInArrow(hashed, "doc_id bigint, text_hash bigint, fp bigint")


def _ball(value: Column, bits: int, radius: int) -> Column:
    """All values within ``radius`` (1 or 2) bits of ``value``, itself included."""
    masks = [0, *(1 << i for i in range(bits))]
    if radius == 2:
        masks += [1 << i | 1 << j for i in range(bits) for j in range(i)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    table = F.array(*[F.lit(m).cast("bigint") for m in signed])
    return F.transform(table, lambda m: value.bitwiseXOR(m))


def _alone_taken_out(prints: DataFrame) -> DataFrame:
    """All fingerprints but those that surely have no neighbour within 4 bits.

    Two fingerprints within 4 bits have a half of 32 bits within 2 bits, so the balls of radius 1
    around those halves meet. A fingerprint that meets nobody in its 66 half variants, or only
    few and all of them farther than 4 bits, has no neighbour and need not send its 2,081 variants.
    Where more than three meet they all stay, whatever their distance.
    """
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)
    halves = F.concat(
        _ball(low, 32, 1),
        F.transform(_ball(high, 32, 1), lambda v: v + F.lit(1 << 32)),
    )
    in_bucket = Window.partitionBy("variant").orderBy("fp")
    sides = [F.lag("fp", i).over(in_bucket) for i in (1, 2)]
    sides += [F.lead("fp", i).over(in_bucket) for i in (1, 2)]
    near = reduce(or_, [_distance(F.col("fp"), other) <= MAX_BITS for other in sides])
    more = F.lag("fp", 3).over(in_bucket).isNotNull() | F.lead("fp", 3).over(in_bucket).isNotNull()
    return (
        prints.select("fp", F.explode(halves).alias("variant"))
        .withColumn("meets", near | more).filter("meets").select("fp").distinct()
    )


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``u, v`` that connect all distinct fingerprints within ``max_bits`` (4).

    Every fingerprint that may have a neighbour sends all 2,081 variants within half the radius,
    two bits. Those that meet in a variant are within four bits of each other, so they need no
    pairs: each is linked to the least of them. Links are deduplicated and verified.
    """
    if max_bits != 4:
        raise ValueError("the balls are made for 4 bits")
    spread = _alone_taken_out(prints).repartition("fp")
    met = Window.partitionBy("variant").orderBy("fp").rowsBetween(Window.unboundedPreceding, 0)
    rooted = spread.select("fp", F.explode(_ball(F.col("fp"), 64, 2)).alias("variant")).select(
        F.col("fp").alias("u"), F.first("fp").over(met).alias("v")
    )
    return rooted.filter("u <> v").distinct().filter(
        _distance(F.col("u"), F.col("v")) <= max_bits
    )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, text_hash, fp, component, component_id`` of every row of ``docs``.

    Documents with fingerprints within ``max_bits`` differing bits are linked. ``component`` is the
    least fingerprint of a component, ``component_id`` its smallest id, which names it. Null, empty and blank texts have fingerprint zero, like any other.
    Rows with a null id count as documents; a component of nothing else has a null name. Equal
    fingerprints are one node, so copies cost nothing; repeated rows repeat.
    """
    own = written(fingerprints(docs, shingle), "fingerprints")
    nodes = written(own.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-prints")
    found = components(near_links(nodes.select("fp"), max_bits))
    named = found.join(nodes, found["node"] == nodes["fp"])
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    grouped = written(
        named.join(least, "component").select("fp", "component", "component_id"), "component-names"
    )
    names = nodes.join(grouped, "fp", "left").select(
        F.col("fp").alias("_fp"), F.coalesce("component", "fp").alias("component"),
        F.coalesce("component_id", "first_id").alias("component_id"),
    )
    return own.join(names, F.col("fp") == F.col("_fp")).select(
        "doc_id", "text_hash", "fp", "component", "component_id"
    )


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
