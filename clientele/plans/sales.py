"""Weekly sales by seller, targets, sign-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.dates import DOT_DATE, parse_date, parse_timestamp_date, week_label
from clientele.functions.text import MONEY, mapped, money, same_text
from clientele.operators.joins import lookup
from clientele.operators.reshape import sum_columns, unpivot_groups

OTHER = "Other"


def clean_sales(staged: DataFrame, sellers: dict[str, str]) -> DataFrame:
    """Typed sales with their week and seller; referrals of nobody listed are Other."""
    return (
        staged.withColumn("inv_total", money("inv_total"))
        .withColumn("amt_paid", money("total_paid"))
        .withColumn("date", parse_date("date"))
        .withColumn("week_number", week_label("date"))
        .withColumn("referral_partner", mapped(F.col("referral_id").cast("string"), sellers, OTHER))
        .drop("total_paid")
    )


def _by_channel(sales: DataFrame) -> DataFrame:
    """Flags for the two channels, worked out once per row rather than once per cell."""
    return sales.select(
        "week_number",
        "referral_partner",
        "product_name",
        "inv_total",
        same_text("sources", "Offline").alias("is_offline"),
        same_text("sources", "Online").alias("is_online"),
    )


def _zero_filled(df: DataFrame, columns: list[str]) -> DataFrame:
    zero = F.lit(0).cast(MONEY)
    return df.withColumns({c: F.coalesce(F.col(c), zero) for c in columns})


def sales_week_pivot(sales: DataFrame, sellers: list[str], advisors: list[str]) -> DataFrame:
    """Revenue per week with a column per seller (offline), group totals and online sales."""
    who, amount, offline = F.col("referral_partner"), F.col("inv_total"), F.col("is_offline")
    cells = {s: ((who == s) & offline, amount) for s in sellers}
    cells |= {
        "advisors": (who.isin(advisors) & offline, amount),
        "total_advised": (who.isin(sellers) & offline, amount),
        "other_offline": (~who.isin(sellers) & offline, amount),
        "online": (F.col("is_online"), amount),
    }
    per_week = _by_channel(sales).groupBy("week_number").agg(
        *sum_columns(cells), F.sum(amount).alias("total_sales"), F.count(amount).alias("num_sales")
    )
    return _zero_filled(per_week, list(cells))


def sales_week_pivot_v2(
    sales: DataFrame,
    sellers: list[str],
    capped_seller: str,
    big_ticket: int,
    big_product: str,
    small_seller: str,
    small_amounts: list[str],
) -> DataFrame:
    """The later layout: big tickets of one product and a seller's fixed-price items apart."""
    who, amount = F.col("referral_partner"), F.col("inv_total")
    cells = {}
    for s in sellers:
        below = amount < big_ticket if s == capped_seller else F.lit(True)
        cells[s] = ((who == s) & F.col("is_offline") & below, amount)
    fixed = [F.lit(a).cast(MONEY) for a in small_amounts]
    cells |= {
        "other": (who == OTHER, amount),
        "big_ticket": (same_text("product_name", big_product) & (amount >= big_ticket), amount),
        "fixed_price": ((who == small_seller) & amount.isin(*fixed), amount),
    }
    per_week = _by_channel(sales).groupBy("week_number").agg(
        *sum_columns(cells), F.sum(amount).alias("total_sales"), F.count(amount).alias("num_sales")
    )
    return _zero_filled(per_week, list(cells))


def sales_vs_target(sales: DataFrame, schedule: DataFrame, members: list[str]) -> DataFrame:
    """Offline revenue of the listed sellers next to their days and target."""
    sums = (
        sales.filter(F.col("referral_partner").isin(members) & same_text("sources", "Offline"))
        .groupBy(F.col("referral_partner").alias("member"))
        .agg(F.sum("inv_total").alias("sale"))
    )
    return lookup(sums, schedule, "member", "name")


def signup_events(staged: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """A consult row and a sign-up row per booking, each in the week of its own date."""
    provider = F.col("provider")
    if names:
        provider = F.coalesce(mapped("provider", names), provider)
    typed = staged.select(
        provider.alias("provider"),
        parse_date("date", DOT_DATE).alias("consult"),
        parse_timestamp_date("record_date").alias("sign"),
    )
    rows = unpivot_groups(
        typed,
        ["provider"],
        [{"date": "consult", "type": F.lit("consult")}, {"date": "sign", "type": F.lit("sign")}],
    )
    return rows.withColumn("week_number", week_label("date"))


def signups_by_week(events: DataFrame, by_provider: bool = False) -> DataFrame:
    """Sign-ups and consults per week, optionally per provider."""
    keys = ["week_number", *(["provider"] if by_provider else [])]
    return events.groupBy(*keys).agg(
        F.count_if(F.col("type") == "sign").alias("number_signed"),
        F.count_if(F.col("type") == "consult").alias("number_consult"),
    )
