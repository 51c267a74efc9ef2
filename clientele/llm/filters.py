"""Rows whose key is surely not in a table are dropped before a shuffle.

The keys of the table are bits of a bitmap, of which every task gets a copy; its size follows the
number of keys up to MOST_BITS (32 MB).  Rows of the table's keys are all kept, and of the others
about one in BITS_EACH (more once the bitmap has its greatest size, two in five at most), so an
exact join or grouping has to follow.  A table of too many keys for
the greatest bitmap makes no filter: all rows go on, and what follows drops the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 15, 1 << 28
# Below this many bits a key, two rows in five or more would pass without being in the table.
FEWEST_EACH = 2
# Bits of one bitmap aggregate, and of one row of the filter that tasks look up.
BITMAP, PIECE = 1 << 15, 1 << 10


def may_be_in(rows: DataFrame, key: Column, table: DataFrame, table_key: Column) -> DataFrame:
    """The rows whose key may be among those of ``table``, which should be a written one: it is
    read twice.  Keys are whole numbers and are never NULL."""
    n = table.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (n * BITS_EACH - 1).bit_length()))
    if n * FEWEST_EACH > bits:
        return rows

    def place(k: Column) -> Column:
        # The key is hashed once more: rows are dealt to tasks by its plain hash.
        return F.xxhash64(k, F.lit("bit")).bitwiseAND(bits - 1)

    at = place(table_key)
    pieces = F.transform(
        F.sequence(F.lit(0), F.lit(BITMAP // PIECE - 1)),
        lambda i: F.struct(
            (F.col("_bitmap") * (BITMAP // PIECE) + i).alias("_piece"),
            F.substring(F.col("_bits"), i * (PIECE // 8) + 1, F.lit(PIECE // 8)).alias("_bits"),
        ),
    )
    known = (
        table.groupBy(F.floor(at / BITMAP).alias("_bitmap"))
        .agg(F.bitmap_construct_agg(at.bitwiseAND(BITMAP - 1)).alias("_bits"))
        .select(F.inline(pieces))
    )
    # Rows are packed, so that their columns may have any name.
    looked = rows.select(F.struct("*").alias("_row"), place(key).alias("_place"))
    within = F.col("_place").bitwiseAND(PIECE - 1)
    byte = F.substring(F.col("_bits"), F.floor(within / 8).cast("int") + 1, F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), within.bitwiseAND(7).cast("int")) == 1
    found = looked.withColumn("_piece", F.floor(F.col("_place") / PIECE)).join(F.broadcast(known), "_piece")
    return found.filter(is_set).select("_row.*")
