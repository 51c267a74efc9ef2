"""Customer value, weekly curves and item allocation: known answers and invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clientele.plans import calendar, contacts, items, value

AS_OF = dt.date(2015, 6, 30)
COLUMNS = "contact_id long, date_created date, life_time int, lead_source string"


def people(spark, ages):
    rows = [(n, AS_OF - dt.timedelta(days=a), a, "src") for n, a in enumerate(ages)]
    return spark.createDataFrame(rows, COLUMNS)


def orders(spark, rows):
    """(contact, day since creation of an as-of-age contact, amount)"""
    df = spark.createDataFrame(rows, "order_id long, contact_id long, date date, amount double")
    money = F.col("amount").cast("decimal(10,2)")
    return df.withColumn("inv_total", money).withColumn("inv_paid", (money / 2).cast("decimal(10,2)"))


@pytest.mark.parametrize(
    "age,expected",
    [
        # NULL while the contact is younger than the previous horizon; 0 exactly at it.
        (0, (5, None, None, None, None)),
        (1, (5, 0, None, None, None)),
        (2, (5, 5, None, None, None)),
        (7, (5, 5, 0, None, None)),
        (8, (5, 5, 5, None, None)),
        (30, (5, 5, 5, 0, None)),
        (31, (5, 5, 5, 5, None)),
        (182, (5, 5, 5, 5, 0)),
        (183, (5, 5, 5, 5, 5)),
        (-1, (None, None, None, None, None)),
    ],
)
def test_horizons_by_age(spark, age, expected):
    created = AS_OF - dt.timedelta(days=age)
    who = spark.createDataFrame([(1, created, age, "s")], COLUMNS)
    row = value.customer_value(who, orders(spark, [(1, 1, created, 5.0)])).first()
    got = (row.cv1d_ts, row.cv7d_ts, row.cv30d_ts, row.cv182d_ts, row.cv365d_ts)
    assert tuple(None if v is None else int(v) for v in got) == expected
    assert row.cvlife_ts == 5


def test_horizon_days_and_contacts_without_orders(spark):
    who = people(spark, [400, 400])
    created = AS_OF - dt.timedelta(days=400)
    days = [-1, 0, 1, 2, 7, 8, 30, 31, 182, 183, 365, 366]
    bought = [(d, 0, created + dt.timedelta(days=d), 1.0) for d in days]
    unknown = [(99, 77, created, 1.0), (98, None, created, 1.0)]
    got = {r.contact_id: r for r in value.customer_value(who, orders(spark, bought + unknown)).collect()}
    row = got[0]
    sums = [row.cv1d_ts, row.cv7d_ts, row.cv30d_ts, row.cv182d_ts, row.cv365d_ts, row.cvlife_ts]
    assert [int(v) for v in sums] == [2, 4, 6, 8, 10, 12]
    assert [int(v) for v in (got[1].cv1d_ts, got[1].cvlife_ts)] == [0, 0]
    assert set(got) == {0, 1}


def test_a_contact_with_a_third_of_all_orders(spark):
    """The same values as a plain join, with the hot contact's orders in many pieces."""
    who = people(spark, [5 * n for n in range(80)])
    contact = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 90)
    bought = spark.range(0, 4000, 1, 8).select(
        contact.cast("long").alias("contact_id"),
        F.date_sub(F.lit(AS_OF), (F.col("id") % 400).cast("int")).alias("date"),
        (F.col("id") % 97).cast("decimal(10,2)").alias("inv_total"),
        (F.col("id") % 31).cast("decimal(10,2)").alias("inv_paid"),
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = {r.contact_id: r for r in value.customer_value(who, bought).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    plain = who.join(bought, "contact_id", "left").withColumn("d", F.datediff("date", "date_created"))
    expected = plain.groupBy("contact_id", "life_time").agg(
        F.sum(F.when(F.col("d").between(0, 30), F.col("inv_total")).otherwise(0)).alias("month"),
        F.coalesce(F.sum("inv_paid"), F.lit(0)).alias("paid"),
    )
    rows = expected.collect()
    assert len(got) == len(rows) == 80
    for r in rows:
        assert got[r.contact_id].cvlife_tp == r.paid
        if r.life_time > 7:
            assert got[r.contact_id].cv30d_ts == r.month


def test_source_totals_equal_contact_totals(spark):
    who = people(spark, [0, 1, 7, 30, 182, 500])
    bought = orders(spark, [(n, n, AS_OF, 10.0 + n) for n in range(6)])
    values = value.customer_value(who, bought)
    by_source = value.value_by_lead_source(values, dt.date(2000, 1, 1)).first()
    assert by_source.c_cvlife_ts == 6
    assert by_source.s_cvlife_ts == values.agg(F.sum("cvlife_ts")).first()[0]
    assert by_source.c_cv365d_ts == 2


def test_unknown_contacts_keep_their_orders(spark):
    out = value.lifecycle_day(orders(spark, [(1, 9, AS_OF, 1.0)]), people(spark, [3]))
    assert [(r.order_id, r.lifecycle_day) for r in out.collect()] == [(1, None)]


def test_purchase_weeks_count_from_one(spark):
    o = spark.createDataFrame(
        [(0, AS_OF), (7, AS_OF), (8, dt.date(2015, 6, 1)), (None, None)], "lifecycle_day int, date_created date"
    )
    weeks = value.purchase_weeks(o, AS_OF, dt.date(2015, 6, 15)).collect()
    assert [(r.lifecycle_day, r.purchase_week_num) for r in weeks] == [(0, 1), (7, 1), (None, None)]


def test_curve_ends_at_grid_revenue_and_population_never_grows(spark):
    who = people(spark, [1, 6, 20, 90, 91, 300])
    rows = [(n, n % 6, AS_OF - dt.timedelta(days=n), 3.0) for n in range(60)]
    by_week = value.lead_source_by_week(
        value.lifecycle_day(orders(spark, rows), who, ("lead_source", "life_time"))
    )
    grid = value.lead_source_week_grid(by_week)
    curve = value.value_curve(grid, value.contacts_by_life_week(who)).orderBy("purchase_week_num").collect()
    inside = by_week.filter("purchase_week_num >= 0").agg(F.sum("sum_total")).first()[0]
    assert curve[-1].cum_inv == inside
    assert [r.purchase_week_num for r in curve] == list(range(len(curve)))
    population = [r.all_id_count for r in curve]
    assert population[0] == 6 and population == sorted(population, reverse=True)


def test_blank_source_on_given_dates(spark):
    who = spark.createDataFrame(
        [(1, AS_OF, 0, " "), (2, AS_OF, 0, None), (3, AS_OF, 0, "x"), (4, dt.date(2015, 1, 1), 9, "")], COLUMNS
    )
    got = value.blank_lead_source_check(who, (AS_OF,)).collect()
    assert [(r.date_created, r.contacts) for r in got] == [(AS_OF, 2)]


def test_allocation_adds_up_to_the_order(spark):
    inv = spark.createDataFrame(
        [(1, "1,2,2", "90.00"), (2, "3", "50.00"), (3, "9", "10.00")], "order_id long, product_ids string, t string"
    ).select("order_id", "product_ids", F.col("t").cast("decimal(10,2)").alias("inv_total"))
    prices = spark.createDataFrame([(1, 10), (2, 20), (3, 0)], "product_id long, p int").select(
        "product_id", F.col("p").cast("decimal(10,2)").alias("product_price")
    )
    got = {(r.invoice_id, r.product_id): r.est_price for r in items.item_sale_allocation(inv, prices).collect()}
    assert got == {(1, 1): pytest.approx(30.0), (1, 2): pytest.approx(60.0), (2, 3): None}


def test_calendar_is_dense(spark):
    df = spark.createDataFrame([(dt.date(2020, 2, 27),), (dt.date(2020, 3, 1),)], "d date")
    got = calendar.rows_per_calendar_day(df, "d").orderBy("date").collect()
    assert [(r.date_text, r.rows) for r in got] == [
        ("02/27/2020", 1), ("02/28/2020", 0), ("02/29/2020", 0), ("03/01/2020", 1)
    ]


def test_lifetime_cutoff(spark):
    df = spark.createDataFrame(
        [(dt.date(2013, 7, 8),), (dt.date(2013, 7, 9),), (None,)], "date_created date"
    )
    got = contacts.contact_lifetime(df, dt.date(2013, 7, 19), dt.date(2013, 7, 8)).collect()
    assert [r.life_time for r in got] == [-1, 10, -1]


def test_validate_phones_empties_bad_ones(spark):
    df = spark.createDataFrame([("x12",), ("415",), (None,)], "phone string")
    assert [r.phone for r in contacts.validate_phones(df).collect()] == ["", "415", ""]


def test_identity_match_never_matches_blanks(spark, rows):
    left = spark.createDataFrame([(1, " A@x "), (2, " "), (3, None), (4, "b@x")], "id long, email string")
    right = spark.createDataFrame([("a@X",), ("a@x",), ("",), (None,)], "email string")
    assert rows(contacts.identity_match(left, right)) == [(1, " A@x ", "a@X")]
