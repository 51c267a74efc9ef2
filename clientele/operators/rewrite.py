"""Column rewrites and row deletes on immutable tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def set_where(df: DataFrame, column: str, cond: Column, value: object) -> DataFrame:
    """Give ``column`` a new value where the condition holds; elsewhere it keeps its own."""
    new = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(column, F.when(cond, new).otherwise(F.col(column)))


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """Remove rows where the condition is true; rows where it is NULL stay."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def add_after(df: DataFrame, after: str, name: str, value: Column) -> DataFrame:
    """Add a column behind another one."""
    at = df.columns.index(after) + 1
    order = [c for c in df.columns if c != name]
    order.insert(at, name)
    return df.withColumn(name, value).select(*order)
