"""Sales opportunities: clean-up, the weekly report and its call list, consult matching."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.functions.dates import days_between, parse_timestamp_date, week_of_year_sunday
from clientele.functions.phones import SECOND, is_bad_phone
from clientele.functions.text import change_text, mapped, not_blank, record_link, same_text
from clientele.operators.hot import spread_join
from clientele.operators.pick import top_per_key
from clientele.operators.reshape import tagged_rows, union_all
from clientele.plans.contacts import dial_area

NEW = "New"
ADDRESSED = "Addressed"
NOT_ADDRESSED = "Not addressed"
WILL_ADDRESS = "Will address"


def clean_opportunities(
    staged: DataFrame, contacts: DataFrame, owner_names: dict[str, str] | None = None
) -> DataFrame:
    """Typed dates, harmonised owner names and the contact's country."""
    dated = staged
    for c in ("next_action_date", "date_create", "last_update"):
        dated = dated.withColumn(c, parse_timestamp_date(c))
    if owner_names:
        dated = dated.withColumn("owner", F.coalesce(mapped("owner", owner_names), "owner"))
    return spread_join(dated, contacts.select("contact_id", "country"), "contact_id", "left")


def with_snapshot_before(current: DataFrame, earlier: DataFrame) -> DataFrame:
    """Each opportunity with its state in an earlier snapshot (one row per id in both)."""
    cols = ("opp", "next_action_date", "stage", "loss_reason", "order_revenue")
    before = earlier.select("opp_id", *(F.col(c).alias(f"old_{c}") for c in cols))
    return current.join(before, "opp_id", "left")


def moved_opportunities(current: DataFrame, earlier: DataFrame) -> DataFrame:
    """Opportunities whose next action moved between two snapshots, and by how many days."""
    both = with_snapshot_before(current, earlier)
    moved = F.col("next_action_date") != F.col("old_next_action_date")
    return (
        both.withColumn("moved", moved)
        .withColumn("days_moved", days_between("old_next_action_date", "next_action_date"))
        .filter("moved")
        .select("opp_id", "old_next_action_date", "next_action_date", "moved", "days_moved")
    )


def opportunity_week_report(
    current: DataFrame,
    earlier: DataFrame,
    week: tuple[date, date],
    next_week: tuple[date, date],
    as_of: date,
    base_url: str,
    label_prefix: str = "W",
) -> DataFrame:
    """The weekly action report.

    Opportunities are New (created in the week), Addressed (due in the week and closed, or
    working and moved beyond it since the earlier snapshot), Not addressed (due in the
    week, last touched outside it) and Will address (due in the next week).  One
    opportunity may be in several classes.
    """
    start, end = (F.lit(d) for d in week)
    due, created, touched = F.col("next_action_date"), F.col("date_create"), F.col("last_update")
    week_no = week_of_year_sunday(F.lit(as_of))
    in_week = due.between(start, end)

    def columns(action: Column, ahead: int = 0, moved: bool = False) -> dict[str, Column]:
        def then(c: str) -> Column:
            now = F.col(c).cast("string")
            return change_text(F.col(f"old_{c}"), now, "--->") if moved else now

        result = F.concat(then("loss_reason"), F.lit(" | "), then("order_revenue"))
        return {
            "week_number": F.concat(F.lit(label_prefix), (week_no + ahead).cast("string")),
            "opty_description": then("opp"),
            "next_action_text": then("next_action_date"),
            "action": action,
            "working_stage": then("stage"),
            "result": result,
        }

    both_texts = F.concat("next_action", F.lit(" | "), F.col("note"))
    was_moved = (due != F.col("old_next_action_date")) & same_text("stage", "Working") & (due > end)
    classes = [
        (NEW, created.between(start, end), columns(both_texts)),
        (ADDRESSED, in_week & same_text("stage", "Won", "Lost"), columns(F.col("note"))),
        (ADDRESSED, was_moved, columns(both_texts, moved=True)),
        (NOT_ADDRESSED, in_week & ~touched.between(start, end), columns(both_texts)),
        (WILL_ADDRESS, due.between(*(F.lit(d) for d in next_week)), columns(both_texts, ahead=1)),
    ]
    rows = tagged_rows(with_snapshot_before(current, earlier), "type", classes)
    return rows.select(
        "week_number",
        record_link(base_url, "opp_id").alias("opty_link"),
        "opp_id",
        "owner",
        "contact_id",
        "contact_name",
        "phone_number",
        "city",
        "state",
        "country",
        "opty_description",
        "next_action_text",
        "action",
        "type",
        "working_stage",
        "result",
    )


def live_opportunity_calls(report: DataFrame, base_url: str) -> DataFrame:
    """Open opportunities of the report with a phone that can be dialled."""
    wanted = report.filter(
        F.col("type").isin(WILL_ADDRESS, NOT_ADDRESSED)
        & not_blank("phone_number")
        & ~is_bad_phone("phone_number", SECOND)
    )
    return wanted.select(
        "opp_id",
        "contact_id",
        "contact_name",
        record_link(base_url, "contact_id").alias("link"),
        "phone_number",
        "country",
        F.col("action").alias("what_done"),
        "owner",
        "opty_link",
        "working_stage",
        "type",
        dial_area("phone_number", "country", layout="paren", unknown_is_domestic=True).alias("time_city"),
    )


def opportunity_activity(report: DataFrame, without_owner: str | None = None) -> DataFrame:
    """Report rows per owner and class."""
    kept = report if without_owner is None else report.filter(F.col("owner") != without_owner)
    return kept.groupBy("owner", "type").agg(F.count("week_number").alias("count"))


def consult_check(bookings: DataFrame, opportunities: DataFrame) -> DataFrame:
    """Bookings with the current opportunity of their contact, if any."""
    opp = top_per_key(opportunities, "contact_id", [F.desc_nulls_last("last_update"), F.desc("opp_id")])
    cols = opp.select("contact_id", "owner", "opp_id", "note", F.col("phone_number").alias("opty_phone"))
    return spread_join(bookings, cols, "contact_id", "left")


def consult_to_opportunity(bookings: DataFrame, opportunities: DataFrame) -> DataFrame:
    """Opportunities a consult may have updated or created, one per contact and class.

    Updated: touched after a booking with the same person.  Created: created after a
    booking.  A pair exists exactly when the latest opportunity is later than the earliest
    booking, so each side is cut to that one row per key before they meet.
    """
    booked = bookings.select("contact_id", F.col("date").alias("booked"), "provider", "name")
    opp = opportunities.select("contact_id", "opp_id", "owner", "stage", "date_create", "last_update")

    first_with = top_per_key(booked, ["contact_id", "provider"], ["booked", "name"])
    last_of = top_per_key(
        opp.withColumnRenamed("owner", "provider"),
        ["contact_id", "provider"],
        [F.desc_nulls_last("last_update"), F.desc("opp_id")],
    )
    touched = first_with.join(last_of, ["contact_id", "provider"]).filter("last_update > booked")
    updated = top_per_key(
        touched, "contact_id", [F.desc("last_update"), F.desc("opp_id"), "booked", "name"]
    ).withColumn("owner", F.col("provider"))

    first = top_per_key(booked, "contact_id", ["booked", "provider", "name"])
    newest = top_per_key(opp, "contact_id", [F.desc_nulls_last("date_create"), F.desc("opp_id")])
    created = first.join(newest, "contact_id").filter("date_create > booked")

    return union_all(
        updated.withColumn("type", F.lit("May be updated")),
        created.withColumn("type", F.lit("Created")),
    ).select(
        "contact_id",
        "name",
        "booked",
        "provider",
        "opp_id",
        "owner",
        "date_create",
        "last_update",
        "stage",
        "type",
    )


def days_away(events: DataFrame, day: str, as_of: date) -> DataFrame:
    """Days from a given day to each event."""
    return events.withColumn("days_away", days_between(F.lit(as_of), day))
