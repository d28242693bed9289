"""Exact quantiles of many measures at once by radix selection: no sort, a histogram for each digit."""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction
from math import ceil, floor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIGIT_BITS = 16


def quantiles(
    counts: DataFrame, group: str, value: str, weight: str, wanted: list[float],
    digit_bits: int = DIGIT_BITS,
) -> dict[str, list[Fraction]]:
    """Linearly interpolated quantiles of whole numbers with weights, for each group.

    ``counts`` is read once for sizes and ranges and once for each digit: values less the least of
    their group are told apart from the highest digit down. In a round only values count that
    agree in all higher digits with a wanted place; of them a histogram over the next digit is
    taken, for all groups and fractions together, and the digit where the place falls is picked.
    A histogram has ``2 ** digit_bits`` rows at most for each group and place. Groups are few, as
    their results come to the driver. Null values are left out, and groups without any other.
    """
    spark = counts.sparkSession
    known = counts.filter(F.col(value).isNotNull()).select(
        F.col(group).alias("g"), F.col(value).cast("bigint").alias("v"), F.col(weight).alias("n")
    )
    sizes = {
        r.g: r for r in known.groupBy("g").agg(
            F.min("v").alias("least"), F.max("v").alias("most"), F.sum("n").alias("size")
        ).collect()
    }
    places = {
        (g, rank): (0, rank)  # digits so far, rank among the values that have them
        for g, r in sizes.items() for f in wanted
        for rank in (floor(_place(f, r["size"])), ceil(_place(f, r["size"])))
    }
    bits = max([(r.most - r.least).bit_length() for r in sizes.values()], default=0)
    for shift in reversed(range(0, bits, digit_bits)):
        rows = [(g, rank, sizes[g].least, digits, left) for (g, rank), (digits, left) in places.items()]
        targets = spark.createDataFrame(rows, "g string, rank bigint, least bigint, above bigint, left bigint")
        prefixes = F.broadcast(targets.select("g", "least", "above").distinct())
        digits = F.shiftright(F.col("v") - F.col("least"), shift)
        histogram = (
            known.join(prefixes, "g").withColumn("digits", digits)
            .filter(F.shiftright("digits", digit_bits) == F.col("above"))
            .groupBy("g", "above", "digits").agg(F.sum("n").alias("n"))
        )
        in_order = Window.partitionBy("g", "above").orderBy("digits")
        running = histogram.withColumn("end", F.sum("n").over(in_order))
        start = F.col("end") - F.col("n")
        found = running.join(F.broadcast(targets.drop("least")), ["g", "above"]).filter(
            (start <= F.col("left")) & (F.col("left") < F.col("end"))
        )
        places = {
            (r.g, r.rank): (r.digits, r.inside)
            for r in found.select("g", "rank", "digits", (F.col("left") - start).alias("inside")).collect()
        }

    def quantile(g: str, fraction: float) -> Fraction:
        place = _place(fraction, sizes[g]["size"])
        lo, hi = (sizes[g].least + places[g, rank][0] for rank in (floor(place), ceil(place)))
        return lo + (hi - lo) * (place - floor(place))

    return {g: [quantile(g, f) for f in wanted] for g in sizes}


def _place(fraction: float, size: int) -> Fraction:
    return Fraction(Decimal(str(fraction))) * (size - 1)
