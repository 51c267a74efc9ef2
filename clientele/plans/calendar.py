"""Dense calendars and week labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.dates import show_date, week_label


def calendar(first: Column, last: Column, one_row: DataFrame) -> DataFrame:
    """One row per day; ``first`` and ``last`` are columns of a one-row table."""
    days = one_row.select(F.explode(F.sequence(first, last)).alias("date"))
    return days.withColumn("date_text", show_date("date"))


def calendar_of(df: DataFrame, day: str) -> DataFrame:
    """The calendar from the first to the last day in a table."""
    span = df.agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
    return calendar(F.col("_first"), F.col("_last"), span)


def rows_per_calendar_day(df: DataFrame, day: str) -> DataFrame:
    """Rows per day with the empty days filled in."""
    per_day = df.groupBy(F.col(day).alias("date")).agg(F.count("*").alias("rows"))
    return calendar_of(per_day, "date").join(per_day, "date", "left").fillna({"rows": 0})


def label_weeks(df: DataFrame, day: str, out: str = "week_number") -> DataFrame:
    """Add the week label of a date column."""
    return df.withColumn(out, week_label(day))
