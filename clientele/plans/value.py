"""Customer value: spend, value by age horizon, weekly curves by lead source."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.config import HORIZONS
from clientele.functions.dates import SLASH_DATE, age_week, days_between, parse_date
from clientele.functions.text import MONEY, is_blank, money, ratio
from clientele.operators.hot import spread_join
from clientele.operators.series import dense_grid, fill_grid, remaining_total, running_total

Horizons = Sequence[tuple[str, int, int | None]]


def measures(horizons: Horizons = HORIZONS, whole: str = "cvlife") -> tuple[str, ...]:
    """Names of the value columns, invoiced (``_ts``) and paid (``_tp``) for each horizon."""
    return tuple(f"{tag}_{kind}" for tag in (*(h[0] for h in horizons), whole) for kind in ("ts", "tp"))


MEASURES = measures()


def clean_invoices(staged: DataFrame, date_format: str = SLASH_DATE) -> DataFrame:
    """Money text to decimals, date text to dates, and what was paid."""
    return (
        staged.withColumn("inv_total", money("inv_total"))
        .withColumn("balance", money("balance"))
        .withColumn("inv_paid", (F.col("inv_total") - F.col("balance")).cast(MONEY))
        .withColumn("date", parse_date("date", date_format))
    )


def total_spend(invoices: DataFrame) -> DataFrame:
    """Invoiced and paid totals per contact."""
    return invoices.groupBy("contact_id").agg(
        F.sum("inv_total").alias("total_spend"), F.sum("inv_paid").alias("total_paid")
    )


def lifecycle_day(
    invoices: DataFrame, contacts: DataFrame, extra: tuple[str, ...] = ("lead_source",)
) -> DataFrame:
    """Every invoice with its contact's creation date and the contact's age on that day.

    Invoices of unknown contacts stay, with NULLs.
    """
    known = contacts.select("contact_id", "date_created", *extra)
    return spread_join(invoices, known, "contact_id", "left").withColumn(
        "lifecycle_day", days_between("date_created", "date")
    )


def _horizon_sum(tag: str, last_day: int, floor: int | None, amount: str, by_age: bool) -> Column:
    """Amounts inside a horizon: 0 for a contact old enough, NULL for a younger one."""
    day, age = F.col("lifecycle_day"), F.col("life_time")
    inside = day.between(0, last_day)
    if not by_age:
        return F.sum(F.when(inside, F.col(amount)).otherwise(0))
    counts = age >= 0 if floor is None else age > floor
    eligible = age >= (0 if floor is None else floor)
    return F.sum(F.when(inside & counts, F.col(amount)).when(eligible, 0))


def customer_value(
    contacts: DataFrame,
    invoices: DataFrame,
    horizons: Horizons = HORIZONS,
    by_age: bool = True,
    whole: str = "cvlife",
) -> DataFrame:
    """Value of every contact by age horizon, invoiced (``_ts``) and paid (``_tp``).

    A horizon is (column tag, last day, age the contact must have passed).  With ``by_age``
    off every contact counts in every horizon, however young it is.

    Orders meet their contact in a join that cuts up hot contacts; the sums per contact
    then combine before they are shuffled.  Contacts without orders are added from the
    contact table, so each contact appears exactly once.
    """
    who = ["contact_id", "date_created", "life_time", "lead_source"]
    known = contacts.select(*who)
    orders = invoices.select("contact_id", "date", "inv_total", "inv_paid")
    met = spread_join(orders, known, "contact_id", "inner").withColumn(
        "lifecycle_day", days_between("date_created", "date")
    )
    no_order = known.select(
        *who,
        F.lit(None).cast("date").alias("date"),
        F.lit(None).cast(MONEY).alias("inv_total"),
        F.lit(None).cast(MONEY).alias("inv_paid"),
        F.lit(None).cast("int").alias("lifecycle_day"),
    )
    sums = []
    for kind, amount in (("ts", "inv_total"), ("tp", "inv_paid")):
        sums += [_horizon_sum(*h, amount, by_age).alias(f"{h[0]}_{kind}") for h in horizons]
        sums.append(F.coalesce(F.sum(amount), F.lit(0).cast(MONEY)).alias(f"{whole}_{kind}"))
    return met.unionByName(no_order).groupBy(*who).agg(*sums)


def value_by_lead_source(
    values: DataFrame, cutoff: date, of: Sequence[str] = MEASURES
) -> DataFrame:
    """Average, number of eligible contacts and sum of every measure per lead source."""
    aggs = []
    for m in of:
        total, eligible = F.sum(m), F.count(m)
        aggs += [
            ratio(total, eligible).alias(f"a_{m}"),
            eligible.alias(f"c_{m}"),
            total.alias(f"s_{m}"),
        ]
    recent = values.filter(F.col("date_created") > F.lit(cutoff))
    return recent.groupBy("lead_source").agg(*aggs)


def purchase_weeks(orders: DataFrame, as_of: date, start: date | None = None) -> DataFrame:
    """Week of each order since its contact's creation, and the contact's own age in weeks.

    Both count from 1.  Orders of contacts from before ``start`` are left out; orders
    without a known contact stay.
    """
    if start is not None:
        early = F.coalesce(F.col("date_created") < F.lit(start), F.lit(False))
        orders = orders.filter(~early)

    def from_one(week: Column) -> Column:
        return F.when(week == 0, 1).otherwise(week)

    return orders.withColumn("purchase_week_num", from_one(age_week("lifecycle_day"))).withColumn(
        "life_total_week_num", from_one(age_week(days_between("date_created", F.lit(as_of))))
    )


def lead_source_by_week(orders: DataFrame) -> DataFrame:
    """Revenue and orders per lead source and week of purchase (day 0 is week 0).

    Orders whose age or whose contact's age is unknown are left out.
    """
    known = orders.filter(F.col("life_time").isNotNull() & F.col("lifecycle_day").isNotNull())
    return (
        known.withColumn("purchase_week_num", age_week("lifecycle_day"))
        .groupBy("lead_source", "purchase_week_num")
        .agg(F.sum("inv_total").alias("sum_total"), F.count("contact_id").alias("count_orders"))
    )


def lead_source_week_grid(by_week: DataFrame) -> DataFrame:
    """Every lead source with every week up to the last one; weeks without orders are 0."""
    grid = dense_grid(by_week, ["lead_source"], "purchase_week_num")
    cells = by_week.select(
        "lead_source",
        "purchase_week_num",
        F.col("sum_total").alias("invoice"),
        "count_orders",
    )
    return fill_grid(grid, cells, ["lead_source", "purchase_week_num"], invoice=0, count_orders=0)


def cumulative_value_curve(grid: DataFrame) -> DataFrame:
    """Revenue accumulated week by week per lead source."""
    return running_total(grid, ["lead_source"], "purchase_week_num", "invoice", "cum_inv")


def contacts_by_life_week(contacts: DataFrame) -> DataFrame:
    """Contacts per lead source and age in weeks; an age of one day is week 0."""
    age = F.col("life_time")
    week = F.when(age == 1, 0).otherwise(age_week(age))
    return contacts.groupBy("lead_source", week.alias("life_week")).agg(
        F.count("contact_id").alias("count")
    )


def population_at_risk(grid: DataFrame, by_life_week: DataFrame) -> DataFrame:
    """For every grid cell, the contacts of the source that have lived at least that long."""
    cells = grid.select(
        "lead_source", F.col("purchase_week_num").alias("week"), F.lit(0).alias("n"), F.lit(1).alias("cell")
    )
    ages = by_life_week.select(
        "lead_source", F.col("life_week").alias("week"), F.col("count").alias("n"), F.lit(0).alias("cell")
    )
    steps = (
        cells.unionByName(ages)
        .groupBy("lead_source", "week")
        .agg(F.sum("n").alias("n"), F.max("cell").alias("cell"))
    )
    lived = remaining_total(steps, ["lead_source"], "week", "n", "all_id_count")
    return lived.filter("cell = 1").select(
        "lead_source", F.col("week").alias("purchase_week_num"), "all_id_count"
    )


def value_curve(grid: DataFrame, by_life_week: DataFrame) -> DataFrame:
    """The cumulative curve together with its denominators.

    Cells and ages are stacked and added up once per source and week, so both running sums
    go over one short table and nothing is joined back.  NULL is a source like any other.
    """
    week = F.col("purchase_week_num").alias("week")
    cells = grid.select("lead_source", week, "invoice", "count_orders", F.lit(0).alias("n"), F.lit(1).alias("cell"))
    ages = by_life_week.select(
        "lead_source",
        F.col("life_week").alias("week"),
        F.lit(0).alias("invoice"),
        F.lit(0).alias("count_orders"),
        F.col("count").alias("n"),
        F.lit(0).alias("cell"),
    )
    steps = (
        cells.unionByName(ages)
        .groupBy("lead_source", "week")
        .agg(*(F.sum(c).alias(c) for c in ("invoice", "count_orders", "n")), F.max("cell").alias("cell"))
    )
    lived = remaining_total(steps, ["lead_source"], "week", "n", "all_id_count")
    summed = running_total(lived, ["lead_source"], "week", "invoice", "cum_inv")
    return summed.filter("cell = 1").select(
        "lead_source",
        F.col("week").alias("purchase_week_num"),
        F.col("invoice").cast(grid.schema["invoice"].dataType).alias("invoice"),
        "count_orders",
        "cum_inv",
        "all_id_count",
    )


def blank_lead_source_check(contacts: DataFrame, dates: tuple[date, ...] | None = None) -> DataFrame:
    """Contacts without a lead source by creation date and age in weeks."""
    blank = contacts.filter(is_blank("lead_source"))
    if dates is not None:
        blank = blank.filter(F.col("date_created").isin(*dates))
    return blank.groupBy("date_created", age_week("life_time").alias("life_time_week")).agg(
        F.count("contact_id").alias("contacts")
    )
