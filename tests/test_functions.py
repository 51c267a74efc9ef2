"""Text, date and phone rules on small inline tables."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clientele.functions import dates, phones, text


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column).first()[0]


@pytest.mark.parametrize("value,blank", [(None, True), ("", True), ("  ", True), (" x", False)])
def test_blank(spark, value, blank):
    assert one(spark, text.is_blank("c"), value) is blank


@pytest.mark.parametrize(
    "value,expected",
    [
        ("$1,234.50", Decimal("1234.50")),
        ("12", Decimal("12.00")),
        ("", Decimal("0.00")),
        (None, Decimal("0.00")),
        ("  ", Decimal("0.00")),
        ("n/a", None),
    ],
)
def test_money(spark, value, expected):
    assert one(spark, text.money("c"), value) == expected


def test_like_any_ignores_case_and_escapes(spark):
    df = spark.createDataFrame([("Bookshop",), ("my DVD set",), ("a+b",), ("aab",), (None,)], "c string")
    hit = text.like_any("c", ["book%", "%dvd%", "a+_"])
    assert [r[0] for r in df.select(hit).collect()] == [True, True, True, False, None]


def test_first_nonblank_and_first_word(spark):
    df = spark.createDataFrame([(" ", None, "x y z")], "a string, b string, c string")
    row = df.select(text.first_nonblank("a", "b", "c"), text.first_word("c"), text.first_word("b")).first()
    assert tuple(row) == ("x y z", "x", None)


def test_ratio_by_zero_is_null(spark):
    assert one(spark, text.ratio(F.col("c"), F.lit(0)), 5, "int") is None


def test_percent_and_change_text_keep_null(spark):
    df = spark.createDataFrame([("a", None)], "a string, b string")
    assert df.select(text.change_text(F.col("a"), F.col("b"), "-->")).first()[0] is None
    assert one(spark, text.percent_text(F.col("c")), 0.12345, "double") == "12.35%"


@pytest.mark.parametrize(
    "value,expected",
    [("1/2/2015", dt.date(2015, 1, 2)), ("12/31/2015", dt.date(2015, 12, 31)), ("13/45/2000", None), ("", None)],
)
def test_parse_date(spark, value, expected):
    assert one(spark, dates.parse_date("c"), value) == expected


def test_other_date_formats(spark):
    assert one(spark, dates.parse_date("c", dates.DOT_DATE), "7.14.2015") == dt.date(2015, 7, 14)
    assert one(spark, dates.parse_date("c", dates.DASH_DATE), "14-7-2015") == dt.date(2015, 7, 14)
    assert one(spark, dates.parse_timestamp_date("c"), "7/14/2015 9:05") == dt.date(2015, 7, 14)


@pytest.mark.parametrize(
    "day,label",
    [("2016-01-01", "W15.53"), ("2015-01-01", "W15.01"), ("2014-12-29", "W15.01"), ("2015-02-10", "W15.07")],
)
def test_week_label_at_year_ends(spark, day, label):
    assert one(spark, dates.week_label(F.col("c").cast("date")), day) == label


def test_week_of_year_sunday_equals_strftime(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2009-12-25', DATE '2017-01-10')) AS d")
    for d, w in days.select("d", dates.week_of_year_sunday("d")).collect():
        assert w == int(d.strftime("%U"))


def test_clock(spark):
    assert one(spark, dates.seconds_of("c"), "27:01:05") == 97265
    assert one(spark, dates.clock_text("c"), 97265, "long") == "27:01:05"
    assert one(spark, dates.hours_minutes_text("c"), 97265, "long") == "27h 01m"
    assert one(spark, dates.clock_text("c"), None, "long") is None


@pytest.mark.parametrize("days,week", [(0, 0), (1, 1), (7, 1), (8, 2), (-3, 0), (None, None)])
def test_age_week(spark, days, week):
    assert one(spark, dates.age_week("c"), days, "int") == week


def test_day_window_across_new_year(spark):
    df = spark.createDataFrame([("1980-12-30",), ("1980-01-02",), ("1980-06-01",)], "c string")
    inside = dates.in_day_window(F.col("c").cast("date"), (12, 28), (1, 3))
    assert [r[0] for r in df.select(inside).collect()] == [True, True, False]


@pytest.mark.parametrize(
    "phone,layout,area",
    [
        ("(415) 555-0100", "any", "415"),
        ("1 (415) 555-0100", "any", "415"),
        ("14155550100", "any", "415"),
        ("4155550100", "plain", "415"),
        ("14155550100", "plain", "415"),
        ("(415) 555-0100", "paren", "415"),
        ("1 (415) 555-0100", "paren", "415"),
        ("+1 (415) 555-0100", "before_paren", "415"),
        ("4155550100", "before_paren", ""),
    ],
)
def test_area_code(spark, phone, layout, area):
    assert one(spark, phones.area_code("c", layout), phone) == area


@pytest.mark.parametrize(
    "phone,where,bad",
    [
        ("x123", phones.FIRST, True),
        ("(415) 5", phones.FIRST, True),
        ("415 ext", phones.LAST, True),
        ("(415", phones.LAST, False),
        ("(415", phones.SECOND, False),
        ("(x15", phones.SECOND, True),
        (" ", phones.FIRST, False),
        (None, phones.LAST, False),
    ],
)
def test_bad_phone(spark, phone, where, bad):
    assert one(spark, phones.is_bad_phone("c", where), phone) is bad


def test_unknown_modes_are_refused(spark):
    with pytest.raises(ValueError):
        phones.area_code("c", "fax")
    with pytest.raises(ValueError):
        phones.is_bad_phone("c", "middle")


def test_mapped_ignores_case_and_has_a_default(spark):
    df = spark.createDataFrame([(" DOB",), ("x",), (None,)], "c string")
    got = df.select(text.mapped("c", {"dob": 3}), text.mapped("c", {"dob": 3}, default=0)).collect()
    assert [tuple(r) for r in got] == [(3, 3), (None, 0), (None, 0)]
