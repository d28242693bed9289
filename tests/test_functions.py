from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillstar.functions import bands, calendar, money, text
from tillstar.operators.quarantine import price, whole_number


def values(spark, column, *inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_ratio_rounds_half_up_once(spark):
    df = spark.createDataFrame(
        [(Decimal("1.00"), Decimal("8.00")), (Decimal("-1.00"), Decimal("8.00")),
         (Decimal("2.00"), Decimal("3.00")), (Decimal("5.00"), Decimal("0.00")),
         (Decimal("1.00"), None), (Decimal("5.35"), Decimal("2.00")),
         (Decimal("1.00"), Decimal("-8.00"))],
        "a decimal(18,2), b decimal(18,2)",
    )
    got = [r[0] for r in df.select(money.ratio(F.col("a"), F.col("b"), 2)).collect()]
    assert got == [
        Decimal("0.13"), Decimal("-0.13"), Decimal("0.67"), None, None, Decimal("2.68"),
        Decimal("-0.13"),
    ]


def test_growth_of_shrinking_revenue(spark):
    df = spark.createDataFrame([(Decimal("99.90"), Decimal("80.00"))],
                               "new decimal(18,2), old decimal(18,2)")
    up, down = df.select(
        money.growth(F.col("new"), F.col("old")), money.growth(F.col("old"), F.col("new"))
    ).first()
    assert (up, down) == (Decimal("24.88"), Decimal("-19.92"))


def test_title_case_follows_letters(spark):
    got = values(spark, text.title_case(F.col("x")),
                 "sun-dried tomatoes", "?NOVA salami", "goat cheese", "l'orange", "")
    assert got == ["Sun-Dried Tomatoes", "?Nova Salami", "Goat Cheese", "L'Orange", ""]


def test_clean_text(spark):
    dirty = ["  a \t b\n", "ＡＢＣ", "x  y", None, "plain text", "ﬁsh", "a b ", "naïve é"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(dirty)], "i int, x string")
    got = [r.x for r in text.with_clean_text(df, ["x"]).orderBy("i").collect()]
    assert got == ["a b", "ABC", "x y", "", "plain text", "fish", "a b", "naïve é"]


def test_strict_dates(spark):
    got = values(spark, calendar.strict_date(F.col("x")), "31-12-2015", "1-1-2015", "31-02-2015",
                 "2015-12-31", "01-01-15", "01/02/2015", "", None)
    assert got == [date(2015, 12, 31), date(2015, 1, 1), None, None, None, None, None, None]


def test_strict_times(spark):
    got = values(spark, calendar.is_strict_time(F.col("x")), "11:38:36", "9:05:01", "24:00:00",
                 "25:00:00", "11:60:00", "11:38", "010:00:00", None)
    assert got == [True, True, False, False, False, False, False, False]


def test_timestamp_of(spark):
    got = values(
        spark, calendar.timestamp_of(F.lit("2015-03-29").cast("date"), F.col("x")), "2:30:05", None
    )
    assert got == [datetime(2015, 3, 29, 2, 30, 5), None]


def test_numbers(spark):
    assert values(spark, whole_number(F.col("x")), "7", "7.0", "1.5", "n/a", "", " 8 ", "1e2") == [
        7, 7, None, None, None, 8, 100]
    assert values(spark, price(F.col("x")), "1.005", "2.675", "abc", "99999999999") == [
        Decimal("1.01"), Decimal("2.68"), None, None]


@pytest.mark.parametrize(
    "hour, part, label",
    [(0, "Pre-Opening", "12 AM"), (10, "Pre-Opening", "10 AM"), (11, "Lunch", "11 AM"),
     (12, "Lunch", "12 PM"), (14, "Afternoon", "2 PM"), (17, "Dinner", "5 PM"),
     (21, "Late Night", "9 PM"), (23, "Late Night", "11 PM"), (24, "Unclassified", "12 PM")],
)
def test_hours(spark, hour, part, label):
    columns = calendar.hour_columns(F.lit(hour))
    got = spark.range(1).select(columns["day_part"], columns["hour_12"]).first()
    assert tuple(got) == (part, label)


def test_calendar_columns(spark):
    got = spark.range(1).select(
        *[c.alias(n) for n, c in calendar.calendar_columns(F.lit("2016-01-03").cast("date")).items()]
    ).first().asDict()
    assert got["date_key"] == 20160103 and got["iso_week"] == 53 and got["day_of_week"] == 7
    assert got["is_weekend"] and got["quarter_name"] == "Q1 2016" and got["day_short"] == "Sun"


def test_bands(spark):
    shares = [Decimal(v) for v in ("0.00", "80.00", "80.01", "95.00", "95.01", "101.00", "101.01")]
    assert values(spark, bands.abc_class(F.col("x")), *shares, kind="decimal(18,2)") == list(
        "AABBCCC")
    assert values(spark, bands.abc_right_closed(F.col("x")), *shares, kind="decimal(18,2)") == [
        "nan", "A", "B", "B", "C", "C", "nan"]
    assert values(spark, bands.trust_label(F.col("x")), 0, 3, kind="int") == [
        "All rows reconciled", "Review 3 rows"]
