"""What changed between two snapshots of one list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.functions.text import change_text


def snapshot_diff(
    old: DataFrame, new: DataFrame, key: str, text: str, arrow: str = "-->"
) -> DataFrame:
    """Removed, Added and Update rows between two snapshots with one row per key.

    Both sides are stacked and grouped by key, which combines map-side; an unchanged key
    gives no row, nor does one whose text is NULL on one side only.
    """

    def side(df: DataFrame, is_new: bool) -> DataFrame:
        return df.select(key, F.col(text).alias("_text"), F.lit(is_new).alias("_new"))

    was = F.bool_or(~F.col("_new"))
    now = F.bool_or(F.col("_new"))
    both = (
        side(old, False)
        .unionByName(side(new, True))
        .groupBy(key)
        .agg(
            was.alias("_was"),
            now.alias("_now"),
            F.max(F.when(~F.col("_new"), F.col("_text"))).alias("_old_text"),
            F.max(F.when(F.col("_new"), F.col("_text"))).alias("_new_text"),
        )
    )
    old_text, new_text = F.col("_old_text"), F.col("_new_text")
    kind = (
        F.when(~F.col("_now"), "Removed")
        .when(~F.col("_was"), "Added")
        .when(old_text != new_text, "Update")
    )
    info = (
        F.when(~F.col("_now"), old_text)
        .when(~F.col("_was"), new_text)
        .otherwise(change_text(old_text, new_text, arrow))
    )
    return both.select(key, info.alias("event_info"), kind.alias("change_type")).filter(
        F.col("change_type").isNotNull()
    )
