"""Relational building blocks against brute force on small tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clientele.operators import diff, hot, joins, pick, reshape, rewrite, series, shares


@pytest.fixture
def skewed(spark):
    """A third of the rows under one key, some NULL keys and a key nothing matches."""
    keyed = (
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 11 == 1, None)
        .otherwise(F.col("id") % 60)
        .alias("k")
    )
    return spark.range(0, 6000, 1, 8).select(keyed, F.col("id").alias("v"))


@pytest.fixture
def many_parts(spark):
    """Many shuffle partitions, and no side so small that nothing is shuffled."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_small_sides_are_sent_and_nothing_is_sketched(spark, skewed, rows):
    dim = spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    for how in hot.HOW:
        joined = hot.spread_join(skewed, dim, "k", how)
        plan = joined._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" in plan and "approx_top_k" not in plan
        assert rows(joined) == rows(skewed.join(dim, "k", how))
    assert hot.is_broadcast(dim) and not hot.is_broadcast(spark.range(10**9))


@pytest.fixture
def equal_rows(spark):
    """A million narrow rows: half of them are one row of one key, the others differ."""
    return spark.range(0, 1_000_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 5000 + 10).alias("k"),
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("v"),
    )


def _sizes(df):
    """Rows of each partition of a plan as it stands."""
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_equal_rows_of_a_hot_key_are_spread(spark, equal_rows, many_parts):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = hot.attach_totals(equal_rows, "k", n=F.count("*"), s=F.sum("v"))
        sizes = _sizes(out)
        assert sum(sizes) == 1_000_000 and max(sizes) <= 2 * 1_000_000 / 32
        assert out.filter("k = 7").agg(F.count("*"), F.min("n"), F.max("s")).first()[:] == (500_000, 500_000, 500_000)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_equal_rows_go_to_the_same_pieces_in_any_order(spark, many_parts):
    """What a task deals out depends on its rows and not on the order it reads them in."""
    data = [(7, k % 3) for k in range(900)] + [(k, k) for k in range(100)]
    dim = spark.range(0, 100).select(F.col("id").alias("k"), F.lit(1).alias("w"))

    def dealt(rows_):
        one = spark.createDataFrame(rows_, "k long, v long").coalesce(1)
        joined = hot.spread_join(one, dim, "k", repeats=True)
        return sorted(map(tuple, joined.groupBy(F.spark_partition_id(), "k", "v").count().collect()))

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        first = dealt(data)
        shuffled = data[:]
        random.Random(1).shuffle(shuffled)
        assert dealt(shuffled) == first == dealt(data[::-1])
        assert len({p for p, k, *_ in first if k == 7}) > 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("how", hot.HOW)
def test_spread_join_is_the_plain_join(spark, skewed, many_parts, rows, how):
    dim = spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    assert rows(hot.spread_join(skewed, dim, "k", how)) == rows(skewed.join(dim, "k", how))


def test_spread_join_on_two_keys(spark, skewed, many_parts, rows):
    facts = skewed.withColumn("m", F.col("v") % 2)
    dim = spark.range(0, 100).select(
        (F.col("id") % 50).alias("k"), F.floor(F.col("id") / 50).alias("m"), F.col("id").alias("w")
    )
    assert rows(hot.spread_join(facts, dim, ["k", "m"])) == rows(facts.join(dim, ["k", "m"], "left"))


def test_hot_keys_finds_the_hot_key_only(spark, skewed, many_parts):
    found = hot.hot_keys(skewed.dropna(), ["k"])
    expected = spark.sql("SELECT xxhash64(7L)").first()[0]
    assert [r._key_hash for r in found.collect()] == [expected]
    assert found.first()._pieces > 8


def test_hot_keys_of_nothing(spark, skewed, many_parts):
    empty = skewed.filter("v < 0")
    assert hot.hot_keys(empty, ["k"]).collect() == []
    assert hot.spread_join(empty, skewed.limit(1), "k").count() == 0
    assert hot.attach_totals(empty, "k", n=F.count("*")).count() == 0


def test_hot_key_is_spread_over_partitions(spark, skewed, many_parts):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dim = spark.range(0, 60).select(F.col("id").alias("k"), F.lit(1).alias("w"))
        joined = hot.spread_join(skewed, dim, "k")
        used = joined.filter("k = 7").groupBy(F.spark_partition_id()).count().count()
        assert used > 3
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_spread_join_refuses_other_joins(spark, skewed):
    with pytest.raises(ValueError):
        hot.spread_join(skewed, skewed, "k", "full")


def test_attach_totals(spark, skewed, many_parts):
    out = hot.attach_totals(skewed, "k", n=F.count("*"), s=F.sum("v"))
    expected = {}
    data = skewed.collect()
    for k, v in data:
        n, s = expected.get(k, (0, 0))
        expected[k] = (n + 1, s + v)
    got = out.collect()
    assert len(got) == len(data)
    assert all((r.n, r.s) == (expected[r.k] if r.k is not None else (None, None)) for r in got)


def test_shares_add_up(spark, skewed, many_parts):
    kept = skewed.dropna()
    by_count = shares.share_of_count(kept, "k", "v", "share").groupBy("k").agg(F.sum("share").alias("s"))
    assert all(abs(r.s - 1) < 1e-9 for r in by_count.collect())
    by_sum = shares.share_of_sum(kept, "k", "v", "share").groupBy("k").agg(F.sum("share").alias("s"))
    assert all(abs(r.s - 1) < 1e-9 for r in by_sum.collect())


def test_top_per_key_prunes_before_the_shuffle(spark, skewed, rows):
    top = pick.top_per_key(skewed.dropna(), "k", [F.desc("v")])
    best = {}
    for k, v in skewed.dropna().collect():
        best[k] = max(v, best.get(k, -1))
    assert dict(rows(top)) == best
    plan = top._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_first_n_per_key(spark, rows):
    df = spark.createDataFrame([(1, 5), (1, 3), (1, 9), (2, 1)], "k int, v int")
    got = rows(pick.first_n_per_key(df, "k", ["v"], 2, "n"))
    assert got == [(1, 3, 1), (1, 5, 2), (2, 1, 1)]


def test_dense_grid_and_totals(spark, rows):
    df = spark.createDataFrame([("a", 0, 5), ("a", 2, 7), ("b", 1, 1), ("b", -2, 9)], "s string, w int, x int")
    grid = series.fill_grid(series.dense_grid(df, ["s"], "w"), df, ["s", "w"], x=0)
    run = series.running_total(grid, ["s"], "w", "x", "cum")
    left = series.remaining_total(run, ["s"], "w", "x", "rest")
    assert rows(left, "s", "w", "x", "cum", "rest") == [
        ("a", 0, 5, 5, 12), ("a", 1, 0, 5, 7), ("a", 2, 7, 12, 7),
        ("b", 0, 0, 0, 1), ("b", 1, 1, 1, 1), ("b", 2, 0, 1, 0),
    ]


def test_snapshot_diff(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (5, None)], "id int, t string")
    new = spark.createDataFrame([(2, "b"), (3, "C"), (4, "d"), (5, "e")], "id int, t string")
    assert rows(diff.snapshot_diff(old, new, "id", "t")) == [
        (1, "a", "Removed"),
        (3, "c-->C", "Update"),
        (4, "d", "Added"),
    ]
    assert diff.snapshot_diff(old, old, "id", "t").count() == 0


def test_id_list_matching(spark, rows):
    df = spark.createDataFrame([(1, "5,6,5"), (2, "9"), (3, ""), (4, None), (5, "6")], "o int, ids string")
    items = spark.createDataFrame([(5, 10), (6, 20)], "pid int, price int")
    got = rows(joins.match_ids(df, "ids", items, "pid"), "o", "pid", "price")
    assert got == [(1, 5, 10), (1, 6, 20), (5, 6, 20)]


def test_lookup_ignores_case_and_spaces(spark, rows):
    df = spark.createDataFrame([(1, " OAK "), (2, "elm"), (3, None)], "id int, city string")
    table = spark.createDataFrame([("Oak", "Z1")], "name string, zone string")
    assert rows(joins.lookup(df, table, "city", "name"), "id", "zone") == [(1, "Z1"), (2, None), (3, None)]


def test_side_table_joins_alike_with_and_without_spreading(spark, skewed, rows):
    dim = spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    assert rows(joins.join_side_table(skewed, dim, "k")) == rows(joins.join_side_table(skewed, dim, "k", spread=True))


def test_pieces_follow_from_content(spark):
    df = spark.range(1_000).selectExpr("id % 3 AS k", "id AS v", "cast(null as string) AS n", "map(1, 2) AS m")
    piece = lambda d: {r.v: r.p for r in d.withColumn("p", hot.row_hash(d)).select("v", "p").collect()}
    assert piece(df) == piece(df.orderBy(F.desc("v")).repartition(7))


def test_more_hot_keys_than_a_thousand(spark, rows):
    keys = spark.range(1_200).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(30))))
    df = keys.select(F.col("id").alias("k"), (F.col("id") * 100 + F.col("copy")).alias("v"))
    found = hot.hot_keys(df, ["k"], parts=4_000)
    assert found.count() == 1_200
    single = spark.range(1_200).select(F.col("id").alias("k"), (F.col("id") + 1).alias("w"))
    joined = hot.spread_join(df, single, "k", hot=found)
    assert joined.count() == 36_000 and joined.filter("w <> k + 1 OR w IS NULL").isEmpty()


def test_exclude_keeps_null_keys(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    listed = spark.createDataFrame([(2, "r"), (1, None)], "who int, reason string")
    assert rows(joins.suppress(df, listed, "id", "who", "reason")) == [(1,), (None,)]


def test_update_from(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, c string")
    other = spark.createDataFrame([(2, "B")], "id int, d string")
    assert rows(joins.update_from(df, other, "id", c="d", e=F.lit(1)), "id", "c", "e") == [
        (1, "a", None),
        (2, "B", 1),
    ]


def test_day_window_includes_both_ends(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 2, 27))], "id int, d date")
    days = [r.x for r in joins.day_window(df, "d", 3, "x").collect()]
    assert days == [dt.date(2020, 2, 27), dt.date(2020, 2, 28), dt.date(2020, 2, 29), dt.date(2020, 3, 1)]


def test_long_literal_tables_lose_the_hint_only(spark):
    hint = lambda df: "ResolvedHint" in df._jdf.queryExecution().toString()
    many = joins.literal_rows(spark, [(1,)] * (joins.MAX_LITERAL_ROWS + 1), "a int")
    assert many.count() == joins.MAX_LITERAL_ROWS + 1 and not hint(many)
    assert hint(joins.literal_rows(spark, [(1,)], "a int"))


def test_delete_keeps_unknown(spark, rows):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    assert rows(rewrite.delete_where(df, F.col("x") > 3)) == [(1,), (None,)]


def test_set_where_and_add_after(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "x int, y string")
    out = rewrite.add_after(rewrite.set_where(df, "y", F.col("x") == 1, "z"), "x", "n", F.lit(0))
    assert out.columns == ["x", "n", "y"]
    assert [r.y for r in out.collect()] == ["z", "b"]


def test_unpivot_and_union(spark, rows):
    df = spark.createDataFrame([(1, "a", "b")], "id int, c1 string, c2 string")
    long = reshape.unpivot_groups(df, ["id"], [{"c": "c1", "n": F.lit(1)}, {"c": "c2", "n": F.lit(2)}])
    assert rows(long) == [(1, "a", 1), (1, "b", 2)]
    both = reshape.union_all(long, spark.createDataFrame([(9,)], "id int"))
    assert rows(both) == [(1, "a", 1), (1, "b", 2), (9, None, None)]


def test_tagged_rows_emit_every_class(spark, rows):
    df = spark.createDataFrame([(1,), (6,), (None,)], "x int")
    classes = [
        ("small", F.col("x") < 10, {"y": F.col("x") * 1}),
        ("big", F.col("x") > 5, {"y": F.col("x") * 2}),
    ]
    assert rows(reshape.tagged_rows(df, "tag", classes), "x", "tag", "y") == [
        (1, "small", 1),
        (6, "big", 12),
        (6, "small", 6),
    ]


def test_joined_text_splits_long_keys(spark):
    from clientele.plans.quality import joined_text_per_key

    random.seed(3)
    texts = [random.choice("abcdef") for _ in range(95)]
    data = [(k, t) for k in (1, None) for t in texts] + [(2, " z"), (2, "y"), (2, None)]
    df = spark.createDataFrame(data, "k int, t string").repartition(5)
    out = joined_text_per_key(df, "k", "t", "all", part_rows=10).collect()
    for key in (1, None):
        pages = sorted((r.part, r["all"]) for r in out if r.k == key)
        assert [p for p, _ in pages] == list(range(10))
        assert ",".join(text for _, text in pages) == ",".join(sorted(texts))
    assert [(r.part, r["all"]) for r in out if r.k == 2] == [(0, "y,z")]


def test_joined_text_of_very_many_equal_texts(spark):
    """A run of equal texts is one row until its pages are written."""
    from clientele.plans.quality import joined_text_per_key

    df = spark.range(0, 100_000, 1, 8).select(F.lit(1).alias("k"), F.lit("same").alias("t"))
    other = spark.createDataFrame([(1, "a"), (1, "zz"), (2, "same")], "k int, t string")
    out = joined_text_per_key(df.unionByName(other), "k", "t", "all", part_rows=999).collect()
    pages = [r["all"] for r in sorted((r for r in out if r.k == 1), key=lambda r: r.part)]
    assert ",".join(pages) == ",".join(["a", *["same"] * 100_000, "zz"])
    assert {len(p.split(",")) for p in pages[:-1]} == {999} and len(pages) == 101
    assert [r["all"] for r in out if r.k == 2] == ["same"]


def test_sets_of_ids_add_up(spark):
    from clientele.operators import bitmaps

    r = random.Random(3)
    data = [(w, r.choice("ab"), r.choice([None, r.randint(0, 70_000), r.randint(0, 50)])) for w in (1, 2, 3) for _ in range(400)]
    df = spark.createDataFrame(data, "week int, class string, id long").repartition(5)
    sets = bitmaps.id_sets(df, ["week", "class"], "id")
    for keys in (["week", "class"], ["class"], ["week"]):
        got = {tuple(x[k] for k in keys): (x.ids, x.n) for x in bitmaps.set_sizes(sets, keys, "ids", "n").collect()}
        expected = {}
        for w, c, i in data:
            if i is not None:
                expected.setdefault(tuple({"week": w, "class": c}[k] for k in keys), []).append(i)
        assert got == {k: (len(set(v)), len(v)) for k, v in expected.items()}
    # Two weeks united, stored and united with a third.
    two = bitmaps.united(sets.filter("week < 3"), "class")
    three = bitmaps.set_sizes(two.unionByName(bitmaps.united(sets.filter("week = 3"), "class")), "class", "ids")
    assert {x["class"]: x.ids for x in three.collect()} == {c: len({i for _, k, i in data if k == c and i is not None}) for c in "ab"}
    assert bitmaps.set_sizes(bitmaps.id_sets(df.limit(0), "week", "id"), "week", "ids").collect() == []
