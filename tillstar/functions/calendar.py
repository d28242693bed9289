"""Strict date and time parsing, calendar attributes and the parts of a trading day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillstar.schemas import DAY_PARTS, PEAK_DAY_PARTS


def strict_date(c: Column) -> Column:
    """A date from ``DD-MM-YYYY`` text (one-digit days and months allowed), else NULL."""
    return F.when(c.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"), F.try_to_date(c, "d-M-yyyy"))


def is_strict_time(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d$"), F.lit(False))


def timestamp_of(day: Column, time: Column) -> Column:
    """Zone-free timestamp from a date and checked ``HH:MM:SS`` text; NULL if either is missing."""
    return F.concat(day.cast("string"), F.lit(" "), time).try_cast("timestamp_ntz")


def date_key(c: Column) -> Column:
    return F.year(c) * 10000 + F.month(c) * 100 + F.day(c)


def calendar_columns(d: Column) -> dict[str, Column]:
    weekday = F.weekday(d) + 1
    return {
        "date_key": date_key(d),
        "full_date": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "quarter_name": F.concat(F.lit("Q"), F.quarter(d), F.lit(" "), F.year(d)),
        "month_number": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "month_short": F.date_format(d, "MMM"),
        "year_month": F.date_format(d, "yyyy-MM"),
        "iso_week": F.weekofyear(d),
        "day_of_month": F.day(d),
        "day_of_week": weekday,
        "day_name": F.date_format(d, "EEEE"),
        "day_short": F.date_format(d, "EEE"),
        "is_weekend": weekday.isin(6, 7),
        "day_of_year": F.dayofyear(d),
    }


def day_part(hour: Column) -> Column:
    chain = F
    for low, high, name in DAY_PARTS:
        chain = chain.when(hour.between(low, high), F.lit(name))
    return chain.otherwise(F.lit("Unclassified"))


def hour_columns(hour: Column) -> dict[str, Column]:
    part = day_part(hour)
    half = F.when(hour < 12, F.lit(" AM")).otherwise(F.lit(" PM"))
    return {
        "time_key": hour,
        "hour_24": hour,
        "hour_label": F.format_string("%02d:00", hour),
        "hour_12": F.concat((F.pmod(hour - 1, F.lit(12)) + 1).cast("string"), half),
        "day_part": part,
        "is_peak_window": part.isin(*PEAK_DAY_PARTS),
    }
