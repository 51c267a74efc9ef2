"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import keep

MOST_ROUNDS = 60


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (or the smaller) neighbours of every node on its smallest neighbour.

    ``links`` has a > b.  Only minima are grouped, and combine map-side; a node with very many
    links is split by the adaptive skew join.
    """
    if large:
        near = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hung = near.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        near = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        least = near.groupBy("u").agg(F.min("v").alias("m"))
        hung = near.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select("u", "m")
        )
    return hung.filter("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """The smallest node reachable from each linked node: columns node, component.

    ``links`` has two columns of one orderable type.  Alternates two star contractions, each a
    group-by and a join, until nothing changes; NULL ends and self-links are left out.
    """
    first, second = (F.col(f"`{c}`") for c in links.columns)
    both = links.select(first.alias("p"), second.alias("q")).filter("p IS NOT NULL AND q IS NOT NULL AND p <> q")
    now = keep(both.select(F.greatest("p", "q").alias("a"), F.least("p", "q").alias("b")).distinct(), "links")
    seen = None
    for _ in range(MOST_ROUNDS):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
        now = keep(_star(_star(now, large=True), large=False), "links")
    else:
        raise RuntimeError(f"components still change after {MOST_ROUNDS} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
