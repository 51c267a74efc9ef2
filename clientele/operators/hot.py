"""Joins that stay balanced when one key holds a large share of the rows.

A fact table joined to a table with one row per key puts every fact of a key into one
shuffle partition.  ``spread_join`` finds the keys that are larger than a partition
should be, cuts each of them into pieces much smaller than a partition,
and repeats the single matching row once per piece.  All other keys join as usual, so
the result is that of the plain join.

Only a join that shuffles can have a hot partition.  Where the planner's own size of the matching
side is under its broadcast threshold, the facts stay where they are, and no sketch is made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key larger than two average partitions has more than 2 / partitions of the rows, so there
# are fewer such keys than half the partitions.  A frequent-items sketch of SLOTS counters per
# partition sees them all; the function's own limit is MOST_SLOTS.
SLOTS = 10
LEAST_SLOTS = 10_000
MOST_SLOTS = 1_000_000
MERGERS = 256
FINE = 16

HOW = ("left", "inner", "left_semi", "left_anti")
_ITEM = "_key_hash"
_PIECES = "_pieces"
_PIECE = "_piece"
_TURN = "_turn"


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, keys: list[str], parts: int | None = None) -> DataFrame:
    """Hashes of the keys larger than two average partitions, with a number of pieces.

    One pass over the key columns and no shuffle of keys: every map task sends a sketch,
    and the sketches merge in two steps, so that no task receives one from each map task.
    The result has fewer rows than there are partitions.  It only steers how rows are spread;
    an estimate that is off changes no result.
    """
    parts = parts or _partitions(df)
    slots = min(MOST_SLOTS, max(LEAST_SLOTS, SLOTS * parts))
    present = df.select(
        F.xxhash64(*keys).alias(_ITEM), F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("_merger")
    )
    sketch = (
        present.groupBy("_merger")
        .agg(
            F.expr(f"approx_top_k_accumulate({_ITEM}, {slots})").alias("seen"),
            F.count("*").alias("total"),
        )
        # Grouped by a constant: an ungrouped merge fails on tasks that receive no sketch.
        .groupBy(F.lit("all"))
        .agg(F.expr("approx_top_k_combine(seen)").alias("seen"), F.sum("total").alias("total"))
        .select(F.expr(f"approx_top_k_estimate(seen, {min(parts, slots)})").alias("top"), "total")
    )
    return (
        sketch.select(F.explode("top").alias("hit"), "total")
        .select(
            F.col("hit.item").alias(_ITEM),
            _cut(F.lit(parts) * F.col("hit.count") / F.col("total")).alias(_PIECES),
        )
        .filter(F.col(_PIECES).isNotNull())
    )


def _cut(worth: Column) -> Column:
    """The number of pieces of a key with ``worth`` partitions' rows; NULL for up to two.

    Pieces fall on partitions by hash: with FINE of them for each partition's worth, no
    partition is far above the mean by chance.
    """
    return F.when(worth > 2, F.ceil(worth * FINE).cast("int"))


def is_broadcast(side: DataFrame) -> bool:
    """Whether the planner will send this side of a join to every task instead of shuffling both.

    The same estimate and threshold decide in the planner; asking for them starts no job.
    """
    most = side.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(side._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= most


def row_hash(df: DataFrame) -> Column:
    """A hash of a row's content.

    Pieces come from it and not from a row's place: a task that runs again behind a shuffle
    reads its rows in another order, and must still deal each of them to the same piece.
    Equal rows share a piece; see ``repeats`` of ``spread_join`` for tables that have many.
    """
    plain = [f.name for f in df.schema if not f.dataType.simpleString().count("map<")]
    return F.xxhash64(*(F.col(f"`{c}`") for c in plain))


def spread_join(
    facts: DataFrame,
    single: DataFrame,
    keys: str | list[str],
    how: str = "left",
    hot: DataFrame | None = None,
    repeats: bool = False,
) -> DataFrame:
    """Equi-join ``facts`` to ``single`` (one row per key, or a few) without a hot partition.

    ``how`` is one of HOW.  ``hot`` may pass a list made by ``hot_keys``: when several joins
    use one key, or when ``facts`` is costly to compute and its source tells as much.

    With ``repeats``, for tables with few columns, a hot key's rows may be equal.  Each task then
    puts the rows of hot keys in the order of their content and deals them out in turn.  Which of
    several equal rows comes first does not matter, so a task that runs again deals the same rows
    to the same pieces, whatever order it reads them in.
    """
    if how not in HOW:
        raise ValueError(f"spread_join does {HOW}, not {how!r}")
    keys = [keys] if isinstance(keys, str) else list(keys)
    if is_broadcast(single):
        return facts.join(single, keys, how)
    some_null = F.greatest(*(F.col(k).isNull().cast("int") for k in keys), F.lit(0)) == 1
    # A NULL key matches nothing; it must not make all such facts one group either.
    plain = facts.dropna(subset=keys) if how in ("inner", "left_semi") else facts
    hot = F.broadcast(hot_keys(plain, keys) if hot is None else hot)
    content = row_hash(plain)
    marked = plain.withColumn(_ITEM, F.xxhash64(*keys)).join(hot, _ITEM, "left")
    if repeats:
        marked = marked.sortWithinPartitions(F.when(some_null | F.col(_PIECES).isNotNull(), content)).withColumn(
            _TURN, F.monotonically_increasing_id()
        )
    turn = F.col(_TURN) if repeats else content
    left = marked.withColumn(
        _PIECE,
        F.when(some_null, -1 - F.pmod(turn, F.lit(_partitions(facts))))
        .otherwise(F.coalesce(F.pmod(turn, F.col(_PIECES).cast("long")), F.lit(0)))
        .cast("int"),
    ).drop(_ITEM, _PIECES, _TURN)
    right = (
        single.withColumn(_ITEM, F.xxhash64(*keys))
        .join(hot, _ITEM, "left")
        .withColumn(_PIECE, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_PIECES), F.lit(1)) - 1)))
        .drop(_ITEM, _PIECES)
    )
    return left.join(right, [*keys, _PIECE], how).drop(_PIECE)


def attach_totals(df: DataFrame, keys: str | list[str], **totals: Column) -> DataFrame:
    """Add per-key aggregates to every row.

    The aggregates combine map-side before they are shuffled, and come back through
    ``spread_join``; a window over the key would pull each key into one task instead.
    The keys to cut up are read off the aggregates: fewer than half as many as there are
    shuffle partitions can be larger than two of them.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    sums = df.groupBy(*keys).agg(
        F.count("*").alias("_rows"), *(agg.alias(name) for name, agg in totals.items())
    )
    if is_broadcast(sums):
        return df.join(sums.drop("_rows"), keys, "left")
    total = sums.agg(F.sum("_rows")).scalar()
    pieces = _cut(F.lit(_partitions(df)) * F.col("_rows") / total)
    hot = sums.select(F.xxhash64(*keys).alias(_ITEM), pieces.alias(_PIECES)).filter(F.col(_PIECES).isNotNull())
    return spread_join(df, sums.drop("_rows"), keys, "left", hot=hot, repeats=True)
