"""Wide to long, long to wide, and unions of branches with different columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_groups(
    df: DataFrame, keep: list[str], groups: list[dict[str, Column | str]]
) -> DataFrame:
    """Turn repeated column groups into rows in one scan.

    Each group maps output names to the column that supplies them.
    """

    def as_struct(group: dict[str, Column | str]) -> Column:
        return F.struct(
            *((F.col(v) if isinstance(v, str) else v).alias(name) for name, v in group.items())
        )

    return df.select(*keep, F.inline(F.array(*(as_struct(g) for g in groups))))


def tagged_rows(df: DataFrame, tag: str, classes: list[tuple[str, Column, dict[str, Column]]]) -> DataFrame:
    """Emit a row for every class it belongs to, in one scan.

    A class is (label, condition, columns): all classes name the same columns.
    """
    rows = [
        F.when(cond, F.struct(F.lit(label).alias(tag), *(v.alias(k) for k, v in cols.items())))
        for label, cond, cols in classes
    ]
    made = F.filter(F.array(*rows), lambda r: r.isNotNull())
    names = set(classes[0][2])
    keep = [c for c in df.columns if c not in names and c != tag]
    return df.select(*keep, F.inline(made))


def sum_columns(cells: dict[str, tuple[Column, Column]]) -> list[Column]:
    """Conditional sums as output columns: name -> (condition, value)."""
    return [F.sum(F.when(cond, value)).alias(name) for name, (cond, value) in cells.items()]


def count_columns(cells: dict[str, Column]) -> list[Column]:
    """Conditional counts as output columns: name -> condition."""
    return [F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in cells.items()]


def union_all(*branches: DataFrame) -> DataFrame:
    """Append branches by column name; a column a branch lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), branches)
