"""Bounded samples of labelled documents for the classifiers, and their common pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most labelled documents, and most code points of them, that a classifier is fitted on.
SAMPLE_ROWS = 3_000
SAMPLE_CHARS = 12_000_000

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids are in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(0))


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII bytes."""
    return (text or "").encode().translate(_WORD_BYTES).split()


def _fitting(sizes: list[tuple[int, int, int, int]], chars: int) -> list[int]:
    """Ids of ``(place, id, label, code points)`` that fit into ``chars``, in order of place."""
    sizes = sorted(sizes)
    if sum(n for *_, n in sizes) <= chars:
        return [i for _, i, _, _ in sizes]
    taken: set[int] = set()
    left = 0
    # each label its own share first, then both what is left
    for own, share in (({1}, chars // 3), ({0}, chars - chars // 3), ({0, 1}, 0)):
        left += share
        room = share if share else left
        for _, i, label, n in sizes:
            if i not in taken and label in own and n <= room:
                taken.add(i)
                room -= n
                left -= n
    return [i for _, i, _, _ in sizes if i in taken]


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learnable: Column,
    rows: int = SAMPLE_ROWS,
    chars: int = SAMPLE_CHARS,
) -> list[tuple[str, int]]:
    """Whole texts with their labels, ``rows`` at most and ``chars`` code points at most.

    A third of the rows may be of label 1, the rest of label 0; ids are taken in the order of
    their hash, so the sample does not depend on the order of the tables. An id whose texts exceed
    what is left of ``chars`` is passed over. Where not all fit, label 1 has a third of ``chars``
    and label 0 the rest, then either may have what the other leaves. ``learnable`` filters
    ``labels`` before anything is learnt from them. An id with several labels has the largest.
    """
    spark = docs.sparkSession
    known = (
        labels.filter(learnable).select("doc_id", F.col(label).cast("int").alias("label"))
        .filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .withColumn("place", F.xxhash64(F.lit(label), "doc_id"))
    )
    share = {1: rows // 3, 0: rows - rows // 3}
    picked = []
    for value, most in share.items():
        picked += known.filter(F.col("label") == value).orderBy("place").limit(most).collect()
    if not picked:
        return []
    wanted = spark.createDataFrame(
        [(r.doc_id, r.label, r.place) for r in picked], "doc_id bigint, label int, place bigint"
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(
        F.broadcast(wanted), "doc_id"  # ``rows`` rows of three numbers at most
    )
    sizes = texts.groupBy("doc_id", "label", "place").agg(
        F.sum(F.coalesce(F.char_length("text"), F.lit(0))).alias("n")
    ).collect()
    ids = _fitting([(r.place, r.doc_id, r.label, r.n) for r in sizes], chars)
    if not ids:
        return []
    chosen = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
    kept = texts.join(F.broadcast(chosen), "doc_id").select("place", "text", "label").collect()
    return [(r.text or "", r.label) for r in sorted(kept, key=lambda r: (r.place, r.text or ""))]
