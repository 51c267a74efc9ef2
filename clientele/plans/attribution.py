"""Revenue of invoices split over the mails that may have caused them.

A mail counts for an invoice of the same contact when the invoice falls into the mail's
window; with n such mails each gets 1/n of the invoice.  How many mails an invoice meets
depends only on contact and day, so invoices and mails are first reduced to one row per
contact and day.  Invoice-mail pairs are never built: a contact with very many invoices
and mails costs no more than its number of days.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientele.config import CREATIVE_PATTERNS
from clientele.functions.text import like_any, ratio
from clientele.operators.hot import spread_join
from clientele.operators.joins import day_window, join_side_table

WINDOW_DAYS = 3


def creative_mails(
    broadcasts: DataFrame, patterns: Iterable[str] = CREATIVE_PATTERNS, advertising: bool = True
) -> DataFrame:
    """Broadcasts whose template is an advertising one, or those whose template is not."""
    is_adv = _is_advertising(patterns)
    return broadcasts.filter(is_adv if advertising else ~is_adv)


def creative_opens(
    opens: DataFrame, broadcasts: DataFrame, patterns: Iterable[str] = CREATIVE_PATTERNS, advertising: bool = True
) -> DataFrame:
    """Opens of advertising mails, or of mails with a template that is not one.

    One mail may have a large part of all opens; its rows are spread.
    """
    wanted = creative_mails(broadcasts, patterns, advertising).select("mail_id").distinct()
    return spread_join(opens, wanted, "mail_id", "left_semi")


def mail_window_days(broadcasts: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """The days on which a mail can still cause an invoice: its date and ``days`` more."""
    return day_window(broadcasts, "date", days, "datecol").select("mail_id", "datecol")


def contact_windows(
    sends: DataFrame,
    broadcasts: DataFrame,
    days: int = WINDOW_DAYS,
    patterns: Iterable[str] | None = None,
) -> DataFrame:
    """Each contact's mails with the last day of their window.

    With ``patterns``, ``is_adv`` tells whether the mail's template is an advertising one (any
    of its templates, should a mail have several).
    """
    marks = [] if patterns is None else [F.max(_is_advertising(patterns)).alias("is_adv")]
    until = broadcasts.groupBy("mail_id").agg(F.date_add(F.max("date"), days).alias("last_date"), *marks)
    received = sends.select("contact_id", "mail_id").dropna().distinct()
    known = until.filter(F.col("last_date").isNotNull())
    return join_side_table(received, known, "mail_id", "inner", spread=True)


def _is_advertising(patterns: Iterable[str]) -> Column:
    return F.coalesce(like_any("template", patterns), F.lit(False))


def _invoice_days(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy("contact_id", F.col("date").alias("day")).agg(
        F.count("inv_id").alias("sales"), F.sum("inv_total").alias("total")
    )


MEASURES = ("num_sale", "effect_sales", "earned")


def _sides(mails: DataFrame) -> dict[str, Column]:
    """The mails to share revenue among, by the prefix of their results: all of them and, where
    they are marked, the advertising ones among themselves."""
    return {"": F.lit(True), **({"adv_": F.col("is_adv")} if "is_adv" in mails.columns else {})}


def _per_mail(mails: DataFrame, parts: DataFrame, day_col: str, keep_rest: bool) -> DataFrame:
    """Bring a contact-day's part back to its mails and add up per mail.

    Parts without a day are invoices no mail accounts for; they come out as the row
    without a mail id, with a number of sales and nothing else.  A contact-day has at most
    one row per mail, so no group here is unbounded.
    """
    sides = _sides(mails)
    sent = mails.select("contact_id", "mail_id", day_col, *([] if len(sides) == 1 else ["is_adv"]))
    met = sent.join(parts, ["contact_id", day_col], "right" if keep_rest else "inner")
    return met.groupBy("mail_id").agg(
        *(F.sum(F.when(on, F.col(p + m))).alias(p + m) for p, on in sides.items() for m in MEASURES)
    )


def _sent_parts(invoices: DataFrame, mails: DataFrame) -> DataFrame:
    """Per contact and last day of a window, what its mails get; per contact and day, what no
    mail accounts for."""
    sides = _sides(mails)
    mail_days = mails.groupBy("contact_id", F.col("last_date").alias("day")).agg(
        *(F.count_if(on).alias(f"{p}mails") for p, on in sides.items())
    )
    days_of = (
        _invoice_days(invoices)
        .unionByName(mail_days, allowMissingColumns=True)
        .groupBy("contact_id", "day")
        .agg(
            F.sum("sales").alias("sales"),
            F.sum("total").alias("total"),
            *(F.sum(f"{p}mails").alias(f"{p}mails") for p in sides),
        )
    )
    # At most one row per calendar day remains in each of these windows.
    by_contact = Window.partitionBy("contact_id")
    onward = by_contact.orderBy("day").rowsBetween(0, Window.unboundedFollowing)
    so_far = by_contact.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    # An invoice without a date meets no mail.
    still_open = {
        f"{p}open": F.coalesce(F.when(F.col("day").isNotNull(), F.sum(f"{p}mails").over(onward)), F.lit(0)) for p in sides
    }
    timeline = days_of.withColumns(still_open)
    ends = F.col("mails").isNotNull()
    columns = []
    for p in sides:
        n = F.col(f"{p}open")
        met = n > 0
        sales = F.when(met, F.sum(F.when(met, F.col("sales"))).over(so_far))
        columns += [
            (sales if p else sales.when(~met, F.col("sales"))).alias(f"{p}num_sale"),
            F.when(met, F.sum(ratio(F.col("sales"), n)).over(so_far)).alias(f"{p}effect_sales"),
            F.when(met, F.sum(ratio(F.col("total"), n)).over(so_far)).alias(f"{p}earned"),
        ]
    summed = timeline.select(
        "contact_id",
        F.when(ends, F.col("day")).alias("last_date"),
        *columns,
        (ends | (F.col("open") == 0)).alias("_wanted"),
    )
    return summed.filter(F.col("_wanted") & F.col("num_sale").isNotNull()).drop("_wanted")


def revenue_by_sent(
    invoices: DataFrame,
    sends: DataFrame,
    broadcasts: DataFrame,
    days: int = WINDOW_DAYS,
    keep_unattributed: bool = True,
) -> DataFrame:
    """Sales and revenue per mail, a mail counting for all invoices up to its last day.

    There is no lower bound: an invoice from before the mail counts too.
    """
    mails = contact_windows(sends, broadcasts, days)
    return _per_mail(mails, _sent_parts(invoices, mails), "last_date", keep_unattributed)


def both_by_sent(
    invoices: DataFrame,
    sends: DataFrame,
    broadcasts: DataFrame,
    days: int = WINDOW_DAYS,
    patterns: Iterable[str] = CREATIVE_PATTERNS,
) -> DataFrame:
    """``revenue_by_sent`` over all mails and, as ``adv_`` columns, over the advertising mails
    among themselves, in one pass."""
    mails = contact_windows(sends, broadcasts, days, patterns)
    return _per_mail(mails, _sent_parts(invoices, mails), "last_date", True)


def first_opens(opens: DataFrame) -> DataFrame:
    """One row per contact and mail: the first day it was opened.  Mail id 0 is no mail."""
    return (
        opens.filter((F.col("mail_id") != 0) & F.col("opened").isNotNull())
        .groupBy("contact_id", "mail_id")
        .agg(F.min("opened").alias("opened"))
    )


def _open_parts(invoices: DataFrame, mails: DataFrame, days: int) -> DataFrame:
    """Per contact and day of opening, what the mails opened on it get."""
    sides = _sides(mails)
    opened_days = mails.groupBy("contact_id", "opened").agg(
        *(F.count_if(on).alias(f"{p}mails") for p, on in sides.items())
    )
    reach = day_window(opened_days, "opened", days, "day")
    # A contact-day is reached from at most days + 1 opening days.
    at_day = Window.partitionBy("contact_id", "day")
    reach = reach.withColumns({f"{p}open": F.sum(f"{p}mails").over(at_day) for p in sides})
    hits = _invoice_days(invoices).join(reach, ["contact_id", "day"], "left")
    columns = []
    for p in sides:
        sales = F.col("sales") if not p else F.when(F.col(f"{p}open") > 0, F.col("sales"))
        columns += [
            F.sum(sales).alias(f"{p}num_sale"),
            F.sum(ratio(F.col("sales"), F.col(f"{p}open"))).alias(f"{p}effect_sales"),
            F.sum(ratio(F.col("total"), F.col(f"{p}open"))).alias(f"{p}earned"),
        ]
    return hits.groupBy("contact_id", "opened").agg(*columns)


def revenue_by_open(
    invoices: DataFrame,
    opens: DataFrame,
    days: int = WINDOW_DAYS,
    keep_unattributed: bool = True,
) -> DataFrame:
    """Sales and revenue per mail, a mail counting from the day it was opened for ``days`` more."""
    mails = first_opens(opens)
    return _per_mail(mails, _open_parts(invoices, mails, days), "opened", keep_unattributed)


def both_by_open(
    invoices: DataFrame,
    opens: DataFrame,
    broadcasts: DataFrame,
    days: int = WINDOW_DAYS,
    patterns: Iterable[str] = CREATIVE_PATTERNS,
) -> DataFrame:
    """``revenue_by_open`` over all mails and, as ``adv_`` columns, over the advertising mails
    among themselves, in one pass."""
    marked = broadcasts.groupBy("mail_id").agg(F.max(_is_advertising(patterns)).alias("is_adv"))
    mails = spread_join(first_opens(opens), marked, "mail_id", "left").fillna({"is_adv": False})
    return _per_mail(mails, _open_parts(invoices, mails, days), "opened", True)


def rows_per_mail(df: DataFrame, out: str) -> DataFrame:
    """Mails delivered (or opened) per mail id."""
    return df.groupBy("mail_id").agg(F.count("contact_id").alias(out))


def with_rate(result: DataFrame, volume: DataFrame, volume_col: str, rate_col: str) -> DataFrame:
    """Add the mail's volume and the revenue per unit of it."""
    return result.join(volume, "mail_id", "left").withColumn(
        rate_col, ratio(F.col("earned"), F.col(volume_col))
    )


def mail_scorecard(both: DataFrame, volumes: list[DataFrame], rate_on: str, rate_col: str) -> DataFrame:
    """Revenue of each mail over all mails and over advertising mails only, side by side.

    ``both`` comes from ``both_by_sent`` or ``both_by_open``.  ``volumes`` are per-mail counts to
    show; the rate is earned over the column ``rate_on``.
    """
    card = both.select(
        "mail_id",
        *(F.col(m).alias(f"all_{m}") for m in MEASURES),
        *(F.col(f"adv_{m}").alias(f"adv_{m}") for m in MEASURES),
    )
    for volume in volumes:
        card = card.join(volume, "mail_id", "left")
    for side in ("all", "adv"):
        rate = ratio(F.col(f"{side}_earned"), F.col(rate_on))
        card = card.withColumn(f"{side}_{rate_col}", rate)
    return card
