"""Lookups, exclusion lists, id lists and date windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions.text import match_key, not_blank
from clientele.operators.hot import spread_join

# A lookup written down in a program carries the broadcast hint up to this many rows.
MAX_LITERAL_ROWS = 10_000


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A lookup table given as Python rows, marked for broadcast while it is short."""
    table = spark.createDataFrame(rows, schema)
    return F.broadcast(table) if len(rows) <= MAX_LITERAL_ROWS else table


def join_side_table(
    df: DataFrame, table: DataFrame, keys: str | list[str], how: str = "left", spread: bool = False
) -> DataFrame:
    """Join a table that is expected to be small and has one row per key.

    The planner knows its size, or the adaptive plan measures it in bytes while it runs, and
    broadcasts it where it is small.  With ``spread``, for keys with few values, hot keys
    are cut up in case it is shuffled.
    """
    return spread_join(df, table, keys, how) if spread else df.join(table, keys, how)


def lookup(df: DataFrame, table: DataFrame, key: str, table_key: str, how: str = "left") -> DataFrame:
    """Add a lookup table's columns by a text key that ignores case and outer spaces.

    The table has one row per key.
    """
    side = table.withColumn("_lookup", match_key(table_key)).drop(table_key)
    return join_side_table(df.withColumn("_lookup", match_key(key)), side, "_lookup", how).drop("_lookup")


def exclude(df: DataFrame, listed: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key is not listed (NULL keys stay).

    For tables with a bounded number of rows per key, such as a list of contacts.
    """
    keys = [on] if isinstance(on, str) else on
    return df.join(listed.select(*keys).distinct(), keys, "left_anti")


def suppress(df: DataFrame, listed: DataFrame, key: str, list_key: str, reason: str) -> DataFrame:
    """Drop rows whose key is listed together with a reason."""
    blocked = listed.filter(F.col(reason).isNotNull()).select(F.col(list_key).alias(key))
    return exclude(df, blocked, key)


def explode_ids(df: DataFrame, ids: str, out: str) -> DataFrame:
    """One row per different id of a comma-separated list; blank entries are skipped."""
    wanted = F.array_distinct(F.filter(F.split(F.col(ids), ","), not_blank))
    return df.withColumn(out, F.explode(wanted))


def match_ids(df: DataFrame, ids: str, items: DataFrame, item_id: str) -> DataFrame:
    """Join each row to the items its id list names; ids that are unknown drop out.

    An id counts once per list, and only when its text is exactly the item's id.
    """
    named = items.withColumn("_id", F.col(item_id).cast("string"))
    return join_side_table(explode_ids(df, ids, "_id"), named, "_id", "inner", spread=True).drop("_id")


def day_window(df: DataFrame, start: str, days: int, out: str) -> DataFrame:
    """One row per day from ``start`` to ``start + days``, both included."""
    return df.withColumn(out, F.explode(F.sequence(F.col(start), F.date_add(start, days))))


def update_from(
    df: DataFrame, other: DataFrame, on: str | list[str], **assign: Column | str
) -> DataFrame:
    """Overwrite columns of ``df`` where ``other`` (one row per key) has a match."""
    keys = [on] if isinstance(on, str) else list(on)
    values = [(F.col(v) if isinstance(v, str) else v).alias(f"_new_{c}") for c, v in assign.items()]
    joined = spread_join(df, other.select(*keys, *values, F.lit(True).alias("_hit")), keys, "left")
    for c in assign:
        old = F.col(c) if c in df.columns else F.lit(None)
        joined = joined.withColumn(c, F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(old))
    return joined.drop("_hit", *(f"_new_{c}" for c in assign))
