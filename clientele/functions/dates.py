"""Date, week and time-of-day rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clientele.functions.text import as_col, first_word

# Formats found in the exports (fixed values).
SLASH_DATE = "M/d/yyyy"
DOT_DATE = "M.d.yyyy"
DASH_DATE = "d-M-yyyy"


def parse_date(c: Column | str, fmt: str = SLASH_DATE) -> Column:
    """Text to a date; unreadable text gives NULL instead of failing the job."""
    return F.try_to_date(F.trim(as_col(c)), fmt)


def parse_timestamp_date(c: Column | str, fmt: str = SLASH_DATE) -> Column:
    """Date part of ``M/d/yyyy H:mm`` text."""
    return parse_date(first_word(F.trim(as_col(c))), fmt)


def show_date(c: Column | str, fmt: str = "MM/dd/yyyy") -> Column:
    return F.date_format(as_col(c), fmt)


def days_between(start: Column | str, end: Column | str) -> Column:
    """Days from ``start`` to ``end``."""
    return F.datediff(as_col(end), as_col(start))


def week_of_year_sunday(d: Column | str) -> Column:
    """Week 0-53 with weeks starting on Sunday; days before the first Sunday are week 0."""
    d = as_col(d)
    return F.floor((F.dayofyear(d) + F.lit(7) - F.dayofweek(d)) / 7).cast("int")


def week_label(d: Column | str) -> Column:
    """ISO week as ``W15.07``; the year is the ISO year, so it is right at year ends."""
    d = as_col(d)
    year = F.extract(F.lit("YEAROFWEEK"), d).cast("string")
    week = F.lpad(F.weekofyear(d).cast("string"), 2, "0")
    return F.concat(F.lit("W"), F.right(year, F.lit(2)), F.lit("."), week)


def day_name(d: Column | str) -> Column:
    """Full English weekday name."""
    return F.date_format(as_col(d), "EEEE")


def age_week(days: Column | str) -> Column:
    """Seven-day bucket of an age in days: 0 for day 0, 1 for days 1-7 and so on."""
    return F.ceil(as_col(days) / F.lit(7)).cast("int")


def seconds_of(c: Column | str) -> Column:
    """``HH:mm:ss`` to seconds; hours may pass 24."""
    part = F.split(as_col(c), ":")
    h, m, s = (F.get(part, F.lit(i)).try_cast("int") for i in range(3))
    return h * 3600 + m * 60 + s


def clock_text(seconds: Column | str) -> Column:
    """Seconds as ``HH:mm:ss``; hours may pass 24."""
    s = as_col(seconds).cast("long")
    text = F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)
    return F.when(s.isNotNull(), text)


def hours_minutes_text(seconds: Column | str) -> Column:
    """Seconds as ``01h 05m``."""
    s = as_col(seconds).cast("long")
    text = F.format_string("%02dh %02dm", F.floor(s / 3600), F.floor(s % 3600 / 60))
    return F.when(s.isNotNull(), text)


def in_day_window(d: Column | str, first: tuple[int, int], last: tuple[int, int]) -> Column:
    """Is the (month, day) of ``d`` within a yearly window, also across New Year?"""
    md = F.month(as_col(d)) * 100 + F.dayofmonth(as_col(d))
    lo, hi = first[0] * 100 + first[1], last[0] * 100 + last[1]
    return md.between(lo, hi) if lo <= hi else (md >= lo) | (md <= hi)
