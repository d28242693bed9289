"""What a set of filters removes in each order, and how its filters interact."""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.tables import ASCII_SPACE, UPPER

_SPACE = r"[\x20\x09-\x0D]+"


def text_failures() -> dict[str, Column]:
    """What each filter on a single text fails, by letter; ``_t`` is the text, never null."""
    text = F.col("_t")
    stripped = F.btrim(text, F.lit(ASCII_SPACE))
    words, kinds = F.col("_words"), F.col("_kinds")
    capitals = F.char_length(text) - F.char_length(F.translate(text, UPPER, ""))
    return {
        "_words": F.when(stripped == "", F.lit(0)).otherwise(F.size(F.split(stripped, _SPACE))),
        "_kinds": F.when(stripped == "", F.lit(0)).otherwise(
            F.size(F.array_distinct(F.split(stripped, _SPACE)))
        ),
        "A": words < 100,
        "B": 100 * kinds.cast("bigint") < 80 * words.cast("bigint"),
        "C": 100 * capitals.cast("bigint") > 10 * F.char_length(text).cast("bigint"),
        "D": text.rlike(r"[#$%&*|]"),
    }


def _judged(docs: DataFrame, part: str) -> DataFrame:
    """Part, id, text digest and mask of failed filters A to D for each row; the texts stay behind."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"),
    )
    how = text_failures()
    rows = rows.withColumns({n: how[n] for n in ("_words", "_kinds")})
    mask = sum(
        (F.when(how[letter], 1 << i).otherwise(0) for i, letter in enumerate("ABCD")), F.lit(0)
    )
    return rows.select(
        "part", "_id", F.unhex(F.sha2("_t", 256)).alias("digest"), mask.cast("int").alias("mask")
    )


def failure_counts(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``part, mask, docs, good, toxic``: rows by the exact set of filters they fail.

    Bit i of ``mask`` stands for the i-th letter of ABCDE. E is failed by a row whose text a row of
    smaller id has, whatever its part. A null part is the empty string, a null text the empty text;
    a row without an id is neither a copy nor makes one. Repeated rows of one id count each, and
    are no copies of each other. A document is good (toxic) if any of its labels says so.

    Texts are reduced to digests where they are read. Rows of one id, text and part are counted
    first, then each text's rows, with those of its smallest id kept apart; both add up on the map
    side, so a third of all rows may be copies of one text. The join back on the text has a row for
    each text and part.
    """
    rows = _judged(docs, part).groupBy("digest", "part", "_id", "mask").agg(
        F.count("*").alias("n")
    )
    verdicts = labels.filter("doc_id IS NOT NULL").groupBy(
        F.col("doc_id").cast("bigint").alias("_of")
    ).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    n = F.col("n")
    known = rows.join(verdicts, F.col("_id") == F.col("_of"), "left").select(
        "digest", "part", "_id", "mask", n,
        (n * F.coalesce("good", F.lit(0))).alias("good"),
        (n * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )
    own = F.struct("n", "good", "toxic")
    has_id = F.col("_id").isNotNull()
    texts = known.groupBy("digest", "part").agg(
        F.first("mask").alias("mask"),
        *[F.sum(F.when(has_id, F.col(c)).otherwise(0)).alias(c) for c in ("n", "good", "toxic")],
        *[F.sum(F.when(has_id, 0).otherwise(F.col(c))).alias(f"{c}_no_id")
          for c in ("n", "good", "toxic")],
        F.min("_id").alias("_id"),
        F.min_by(F.when(has_id, own), "_id").alias("first"),
    )
    least = texts.groupBy(F.col("digest").alias("_digest")).agg(F.min("_id").alias("_least"))
    marked = texts.join(least, F.col("digest") == F.col("_digest")).withColumn(
        "_leads", F.coalesce(F.col("_id") == F.col("_least"), F.lit(False))
    )

    def spared(c: str) -> Column:
        leading = F.when(F.col("_leads"), F.col("first")[c]).otherwise(0)
        return F.col(f"{c}_no_id") + leading

    cells = F.array(
        F.struct(F.col("mask").alias("mask"), *[spared(c).alias(c) for c in ("n", "good", "toxic")]),
        F.struct((F.col("mask") + 16).alias("mask"), *[
            (F.col(c) - F.when(F.col("_leads"), F.col("first")[c]).otherwise(0)).alias(c)
            for c in ("n", "good", "toxic")
        ]),
    )
    return (
        marked.select("part", F.inline(cells)).groupBy("part", "mask")
        .agg(F.sum("n").alias("docs"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    )


def paths(filters: int) -> tuple[list[int], list[int]]:
    """Orders that reach each state, and orders that leave it for the state of all filters.

    A state is the set of filters applied so far, as a mask. Reaching counts go forward over the
    edges of the lattice, leaving counts go backward.
    """
    full = (1 << filters) - 1
    reach, leave = [0] * (full + 1), [0] * (full + 1)
    reach[0] = leave[full] = 1
    for state in range(full + 1):  # a state's mask is above that of any state before it
        for f in range(filters):
            if not state >> f & 1:
                reach[state | 1 << f] += reach[state]
    for state in range(full, -1, -1):
        for f in range(filters):
            if state >> f & 1:
                leave[state ^ 1 << f] += leave[state]
    return reach, leave


def interactions(counts: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """One row for each part, order of the filters and step, from ``part, mask, docs, good, toxic``.

    Every edge of the subset lattice (a state and the filter applied next) sums what it removes,
    leaves and finds removed already; there are ``n * 2 ** (n - 1)`` edges for a part, whatever the
    number of rows. Steps of all orders read their edge. The Shapley sum of a filter weighs its
    edges with the orders that run through them: those that reach its start times those that leave
    its end. Masks that no row has count as 0; without rows there are no parts.
    """
    n = len(letters)
    if n > 7:
        raise ValueError("the orders of more than seven filters are too many rows")
    reach, leave = paths(n)
    edges = [
        (s, f, reach[s] * leave[s | 1 << f]) for s in range(1 << n) for f in range(n) if not s >> f & 1
    ]
    cells = F.array(*[
        F.struct(F.lit(s).alias("state"), F.lit(f).alias("f"), F.lit(1 << f).alias("bit"),
                 F.lit(w).cast("bigint").alias("w"))
        for s, f, w in edges
    ])
    mask, state, bit = F.col("mask"), F.col("state"), F.col("bit")
    fails = mask.bitwiseAND(bit) != 0
    here = mask.bitwiseAND(state) == 0
    docs = F.col("docs")

    def add(what: Column, of: Column = docs) -> Column:
        return F.sum(F.when(what, of).otherwise(0)).cast("bigint")

    sums = (
        counts.select("part", "mask", "docs", "good", "toxic", F.inline(cells))
        .groupBy("part", "state", "f", "w").agg(
            add(here & ~fails).alias("kept"),
            add(here & fails).alias("removed"),
            add(~here & fails).alias("redundant"),
            add(mask == bit).alias("unique_fails"),
            add(here & fails, F.col("good")).alias("good_lost"),
            add(here & fails, F.col("toxic")).alias("toxic_lost"),
        )
    )
    # a filter's edges in a part meet in one window: their number is fixed
    own = Window.partitionBy("part", "f")
    edges_of = sums.withColumn("shapley", F.sum(F.col("removed") * F.col("w")).over(own))
    steps = []
    for order in permutations(range(n)):
        name, seen = "".join(letters[f] for f in order), 0
        for step, f in enumerate(order, 1):
            steps.append((name, step, seen, f))
            seen |= 1 << f
    assert len(steps) == n * factorial(n)
    table = counts.sparkSession.createDataFrame(
        steps, "filter_order string, step int, state int, f int"
    )
    # the steps of all orders: as many rows as the letters allow, whatever the data
    return edges_of.join(F.broadcast(table), ["state", "f"]).drop("state", "f", "w")
