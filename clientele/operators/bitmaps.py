"""Exact distinct counts that add up: sets of whole-number ids as bitmaps.

A set is cut into buckets of 32,768 neighbouring ids, and each bucket that holds any is a row
with a bitmap of 4 KB.  Sets of days, weeks or classes are stored beside their snapshots and
united for any window later, without the rows they came from; a count over a union is
exact.  Ids should be dense, as keys of one table are: a bucket takes its 4 KB for one id too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, BITS, ROWS = "bucket", "bits", "row_count"


def id_sets(df: DataFrame, keys: str | list[str], id_col: str) -> DataFrame:
    """The set of ids of every key as rows of keys, bucket, bits and the bucket's number of rows.

    NULL ids are in no set.  Bitmaps are combined before they are shuffled.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    known = df.filter(F.col(id_col).isNotNull())
    return known.groupBy(*keys, F.bitmap_bucket_number(id_col).alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias(BITS), F.count("*").alias(ROWS)
    )


def united(sets: DataFrame, keys: str | list[str]) -> DataFrame:
    """The unions of the sets that share ``keys``, in the same form."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return sets.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS), F.sum(ROWS).alias(ROWS))


def set_sizes(sets: DataFrame, keys: str | list[str], ids: str, rows: str | None = None) -> DataFrame:
    """How many different ids (and, if asked, rows with an id) there are for each key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    counted = [F.sum(F.bitmap_count(BITS)).alias(ids)]
    if rows is not None:
        counted.append(F.sum(ROWS).alias(rows))
    return united(sets, keys).groupBy(*keys).agg(*counted)
