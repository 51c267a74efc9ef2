"""Dense week grids and running totals over rows that are already aggregated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense_grid(df: DataFrame, keys: list[str], index: str, last: Column | None = None) -> DataFrame:
    """Every key with every index from 0 to the greatest one in ``df``.

    The greatest index is a scalar subquery and the indexes are generated per key, so
    nothing is collected and no two tables are crossed.
    """
    if last is None:
        last = df.agg(F.max(index)).scalar()
    span = F.sequence(F.lit(0), F.greatest(last.cast("int"), F.lit(0)))
    return df.select(*keys).distinct().withColumn(index, F.explode(span))


def fill_grid(grid: DataFrame, values: DataFrame, on: list[str], **defaults: object) -> DataFrame:
    """Left-join values to a grid and put the default where a cell has no value.

    NULL is a key like any other.
    """
    mine = values.withColumnsRenamed({c: f"_{c}" for c in on})
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return grid.join(mine, same, "left").drop(*(f"_{c}" for c in on)).fillna(defaults)


def running_total(df: DataFrame, keys: list[str], index: str, value: str, out: str) -> DataFrame:
    """Sum of ``value`` up to and including each index; ``df`` has one row per key and index."""
    upto = Window.partitionBy(*keys).orderBy(index).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(upto))


def remaining_total(df: DataFrame, keys: list[str], index: str, value: str, out: str) -> DataFrame:
    """Sum of ``value`` from each index on; ``df`` has one row per key and index."""
    downto = Window.partitionBy(*keys).orderBy(F.desc(index)).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(downto))
