"""Counts and sums used to check a load."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientele.functions.text import is_blank, not_blank
from clientele.sources.tables import new_table_path, save


def contact_quality(contacts: DataFrame) -> DataFrame:
    """Rows, different contacts, contacts with a phone and different phones."""
    with_phone = F.when(not_blank("phone"), F.col("contact_id"))
    return contacts.agg(
        F.count("contact_id").alias("row_count"),
        F.countDistinct("contact_id").alias("contacts"),
        F.countDistinct(with_phone).alias("contacts_with_phone"),
        F.countDistinct("phone").alias("phones"),
    )


def value_reconciliation(by_source: DataFrame) -> DataFrame:
    """Totals over all lead sources, to be held against the contact-level totals."""
    return by_source.agg(
        F.count("*").alias("sources"),
        F.sum("c_cvlife_ts").alias("contacts"),
        F.sum("s_cvlife_ts").alias("total_spend"),
        F.sum("s_cvlife_tp").alias("total_paid"),
    )


def blank_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """How many rows leave each column blank."""
    return df.agg(*(F.count_if(is_blank(c)).alias(f"blank_{c}") for c in columns))


def values_of(df: DataFrame, column: str) -> DataFrame:
    """The different values of a column."""
    return df.select(column).distinct()


def joined_text_per_key(
    df: DataFrame, key: str, text: str, out: str, sep: str = ",", part_rows: int = 10_000, folder: str | None = None
) -> DataFrame:
    """All texts of a key as one separated, sorted text, in pages of ``part_rows`` texts.

    ``part`` numbers a key's pages from 0: its pages in order, with the separator between them,
    are the whole text.  NULL is a key like any other.

    Equal texts of a key are counted first, which combines them before they are shuffled: a run of
    one text is one row however often it comes.  Runs are sorted by key and text over all
    machines and written to ``folder``, so that every later step sees the same slices.  A run's
    place in its key is that in its slice plus the sizes of the key's slices before.  A run is cut
    where pages end, and each page repeats its part of it; no task holds a key.
    """
    spark = df.sparkSession
    rows = df.filter(F.col(text).isNotNull()).select(F.col(key).alias("_k"), F.ltrim(text).alias("_t"))
    runs = rows.groupBy("_k", "_t").agg(F.count("*").alias("_n"))
    sliced = runs.repartitionByRange("_k", "_t").withColumn("_slice", F.spark_partition_id())
    kept = save(sliced, folder or new_table_path(spark, "sorted-texts"))
    earlier = Window.partitionBy("_k").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        kept.groupBy("_k", "_slice")
        .agg(F.sum("_n").alias("_all"))
        .select(F.col("_k").alias("_bk"), F.col("_slice").alias("_bs"), F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_base"))
    )
    in_slice = Window.partitionBy("_k", "_slice").orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)
    placed = kept.withColumn("_before", F.coalesce(F.sum("_n").over(in_slice), F.lit(0))).join(
        bases, F.col("_k").eqNullSafe(F.col("_bk")) & (F.col("_slice") == F.col("_bs"))
    )
    start = F.col("_base") + F.col("_before")
    page_of = lambda at: F.floor(at / part_rows).cast("long")
    paged = placed.select("_k", "_t", start.alias("_from"), (start + F.col("_n")).alias("_to")).withColumn(
        "part", F.explode(F.sequence(page_of(F.col("_from")), page_of(F.col("_to") - 1)))
    )
    low = F.greatest(F.col("_from"), F.col("part") * part_rows)
    high = F.least(F.col("_to"), (F.col("part") + 1) * part_rows)
    in_page = F.array_sort(F.collect_list(F.struct(low.alias("at"), "_t", (high - low).cast("int").alias("n"))))
    texts = F.flatten(F.transform(in_page, lambda x: F.array_repeat(x["_t"], x["n"])))
    return (
        paged.groupBy("_k", "part")
        .agg(F.array_join(texts, sep).alias(out))
        .select(F.col("_k").alias(key), "part", out)
    )
