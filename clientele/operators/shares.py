"""Shares of a group: one part of its count, or a value over the group's sum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.text import ratio
from clientele.operators.hot import attach_totals


def share_of_count(
    df: DataFrame, keys: str | list[str], counted: Column | str, share_col: str
) -> DataFrame:
    """``1 / count(counted)`` within the group; NULL when nothing is counted."""
    out = attach_totals(df, keys, _n=F.count(counted))
    return out.withColumn(share_col, ratio(F.lit(1), F.col("_n"))).drop("_n")


def share_of_sum(df: DataFrame, keys: str | list[str], value: str, share_col: str) -> DataFrame:
    """``value / sum(value)`` within the group; NULL when the sum is 0."""
    out = attach_totals(df, keys, _sum=F.sum(value))
    return out.withColumn(share_col, ratio(F.col(value), F.col("_sum"))).drop("_sum")
