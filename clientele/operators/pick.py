"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: str | list[str], order: list[Column | str]) -> DataFrame:
    """The first row of every key in the stated order.

    ``order`` has to end in a column that makes the choice unique.  Spark keeps only the
    leading row per key and map task before the shuffle, so a hot key stays small.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def first_n_per_key(
    df: DataFrame, keys: str | list[str], order: list[Column | str], n: int, number_col: str
) -> DataFrame:
    """The first ``n`` rows of every key, numbered from 1 (pruned map-side like the above)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(number_col, place).filter(F.col(number_col) <= n)
