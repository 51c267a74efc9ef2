"""Filters of bounded size keep every row of the table's keys and few others."""

import pytest
from pyspark.sql import functions as F

from clientele.llm import filters


def passed(spark, every, inside):
    rows = spark.range(-every // 2, every // 2).withColumn("_bits", F.lit("x"))
    table = spark.createDataFrame([(k,) for k in inside], "k long")
    found = filters.may_be_in(rows, F.col("id"), table, F.col("k"))
    assert found.columns == rows.columns
    return [r.id for r in found.collect()]


@pytest.mark.parametrize("step", [3, 400])
def test_all_of_the_table_and_few_others(spark, step):
    inside = set(range(-15_000, 15_000, step))
    ids = passed(spark, 30_000, inside)
    assert len(ids) == len(set(ids)) and inside <= set(ids)
    assert len(ids) - len(inside) <= 1.3 * (30_000 - len(inside)) / filters.BITS_EACH


def test_no_keys_and_too_many(spark, monkeypatch):
    assert passed(spark, 1_000, []) == []
    monkeypatch.setattr(filters, "MOST_BITS", filters.LEAST_BITS)
    assert len(passed(spark, 40_000, range(17_000))) == 40_000
    some = passed(spark, 40_000, range(8_000))
    assert set(range(8_000)) <= set(some) and len(some) < 16_000


def test_few_bits_a_key_still_keep_the_table(spark, monkeypatch):
    monkeypatch.setattr(filters, "MOST_BITS", 1 << 16)
    inside = set(range(0, 90_000, 3))
    assert inside <= set(passed(spark, 200_000, inside))
