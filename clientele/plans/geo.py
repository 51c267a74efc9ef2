"""Contacts by part of the world."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.config import GEO_CANADA, GEO_NONE, GEO_NONE_COUNT, GEO_US
from clientele.functions.text import like_any, same_text


def geo_partition(cells: DataFrame) -> DataFrame:
    """Each id once per class it has a cell in: US, CANADA, NA; INT when it has none of them."""

    def seen(cond: Column) -> Column:
        return F.bool_or(F.coalesce(cond, F.lit(False)))

    flags = cells.groupBy("id").agg(
        seen(like_any("geocell", [GEO_US])).alias("us"),
        seen(like_any("geocell", [GEO_CANADA])).alias("canada"),
        seen(same_text("geocell", GEO_NONE) & (F.col("ct") == GEO_NONE_COUNT)).alias("none"),
    )
    us, canada, none = F.col("us"), F.col("canada"), F.col("none")
    classes = F.array(
        F.when(us, "US"),
        F.when(canada, "CANADA"),
        F.when(none, "NA"),
        F.when(~us & ~canada & ~none, "INT"),
    )
    return flags.select("id", F.explode(F.array_compact(classes)).alias("country"))


def geo_counts(partition: DataFrame) -> DataFrame:
    """Ids per class."""
    return partition.groupBy("country").agg(F.countDistinct("id").alias("ids"))
