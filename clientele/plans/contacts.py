"""Contact clean-up, phone checks and the contact profile."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.config import DOMESTIC
from clientele.functions.dates import (
    SLASH_DATE,
    days_between,
    in_day_window,
    parse_date,
    parse_timestamp_date,
)
from clientele.functions.phones import FIRST, area_code, is_bad_phone, usable_phone
from clientele.functions.text import (
    as_col,
    first_nonblank,
    is_blank,
    match_key,
    not_blank,
    record_link,
    same_text,
    whole_number,
)
from clientele.operators.hot import spread_join


def birth_year(birthday: Column | str, year_birth: Column | str) -> Column:
    """Last four characters of the birthday, or the year typed into its own field."""
    return whole_number(first_nonblank(F.right(F.trim(as_col(birthday)), F.lit(4)), year_birth))


def clean_contacts(staged: DataFrame, ref_year: int) -> DataFrame:
    """One typed row per exported contact.

    The phone falls back to the second one; the country falls back from the billing to
    the shipping address, the opt-in form and the address of the request.
    """
    born = birth_year("birthday", "year_birth")
    return staged.select(
        F.col("id").alias("contact_id"),
        "first_name",
        "last_name",
        first_nonblank("phone_1", "phone_2").alias("phone"),
        F.when(born > 0, F.lit(ref_year) - born).alias("age"),
        first_nonblank("bill_country", "ship_country", "opt_country", "ip_country").alias("country"),
        first_nonblank("bill_city", "ship_city", "ip_city").alias("city"),
        first_nonblank("bill_state", "ship_state", "ip_state").alias("state"),
        "email",
        parse_timestamp_date("date_created").alias("date_created"),
        "lead_source",
        parse_date("dob", SLASH_DATE).alias("dob"),
        "owner_id",
    )


def contact_lifetime(contacts: DataFrame, as_of: date, cutoff: date) -> DataFrame:
    """Add ``life_time`` in days; -1 for contacts without a date or from before the cut-off."""
    created = F.col("date_created")
    age = days_between(created, F.lit(as_of))
    return contacts.withColumn("life_time", F.when(created > F.lit(cutoff), age).otherwise(-1))


def validate_phones(contacts: DataFrame, where: str = FIRST) -> DataFrame:
    """Empty the phones that fail the digit check."""
    return contacts.withColumn("phone", usable_phone("phone", where))


def bad_phone_list(contacts: DataFrame, phone: str, where: str = FIRST) -> DataFrame:
    """Ids and phones that hold text but fail the check."""
    return contacts.filter(is_bad_phone(phone, where))


def flag_known(contacts: DataFrame, known: DataFrame, key: str, flag: str) -> DataFrame:
    """``Yes`` for contacts that also occur in another list, else ``No``."""
    seen = known.select(key).distinct().withColumn("_seen", F.lit(True))
    hit = F.when(F.col("_seen"), "Yes").otherwise("No")
    return contacts.join(seen, key, "left").withColumn(flag, hit).drop("_seen")


def country_group(country: Column | str) -> Column:
    """Domestic or International; an unknown country is International."""
    return F.when(same_text(country, *DOMESTIC), "Domestic").otherwise("International")


def dial_area(
    phone: Column | str,
    country: Column | str,
    city: Column | str | None = None,
    layout: str = "any",
    unknown_is_domestic: bool = False,
) -> Column:
    """Key into the time-zone lookup: area code, else country, else city."""
    domestic = same_text(country, *DOMESTIC)
    if unknown_is_domestic:
        domestic = F.coalesce(domestic, F.lit(False)) | is_blank(country)
    place = first_nonblank(country) if city is None else first_nonblank(country, city)
    return F.when(domestic & not_blank(phone), area_code(phone, layout)).otherwise(place)


def birthday_list(
    contacts: DataFrame,
    opportunities: DataFrame | None,
    first: tuple[int, int],
    last: tuple[int, int],
    base_url: str = "",
) -> DataFrame:
    """Contacts with a phone whose birthday falls into the window, as leads.

    ``opportunities``, if given, has one row per contact.
    """
    group = country_group("country")
    wanted = contacts.filter(in_day_window("dob", first, last) & not_blank("phone"))
    held: tuple[str, ...] = ()
    if opportunities is not None:
        held = ("opty_owner", "opty_link", "stage")
        opp = opportunities.select(
            "contact_id",
            F.col("owner").alias("opty_owner"),
            record_link(base_url, "opp_id").alias("opty_link"),
            "stage",
        )
        wanted = wanted.join(opp, "contact_id", "left")
    return wanted.select(
        "contact_id",
        F.concat("first_name", F.lit(" "), "last_name").alias("name"),
        F.lit("Birthday this week").alias("what_done"),
        F.lit("DOB").alias("segment"),
        F.when(group == "Domestic", "seg5").otherwise("seg3").alias("actions"),
        "phone",
        "country",
        group.alias("seg_country"),
        *held,
        dial_area("phone", "country").alias("time_city"),
    )


def master_profile(contacts: DataFrame, spend: DataFrame, mail_out: DataFrame) -> DataFrame:
    """Contacts with their spend and mail-out segment; ``N`` when they are in no segment."""
    return (
        contacts.join(spend.select("contact_id", "total_spend", "total_paid"), "contact_id", "left")
        .join(mail_out.select("contact_id", "segment"), "contact_id", "left")
        .withColumn("segment", F.coalesce("segment", F.lit("N")))
    )


def activity_counts(activity: DataFrame, after: date | None = None) -> DataFrame:
    """Opened and clicked mails per contact, over opened rows; optionally only after a date."""
    opened, clicked = F.col("opened"), F.col("clicked")
    if after is None:
        is_open, is_click = opened.isNotNull(), clicked.isNotNull()
    else:
        is_open, is_click = opened > F.lit(after), clicked > F.lit(after)
    return (
        activity.filter(opened.isNotNull())
        .groupBy("contact_id")
        .agg(F.count_if(is_open).alias("num_opened"), F.count_if(is_click).alias("num_clicked"))
    )


def identity_match(left: DataFrame, right: DataFrame) -> DataFrame:
    """Ids of one system whose e-mail the other system knows too.

    A blank address identifies nobody.  The other side is reduced to its different
    addresses first, so the result never grows beyond the left side.
    """
    known = (
        right.filter(not_blank("email"))
        .groupBy(match_key("email").alias("_email"))
        .agg(F.min("email").alias("email_b"))
    )
    mine = left.filter(not_blank("email")).select(
        "id", F.col("email").alias("email_a"), match_key("email").alias("_email")
    )
    return spread_join(mine, known, "_email", "inner").drop("_email")


def opt_out_mails(opt_outs: DataFrame, mails: DataFrame, *also: str) -> DataFrame:
    """The mails that contacts on the opt-out list had received, with further columns asked for."""
    listed = opt_outs.select("contact_id", "type").distinct()
    sent = mails.select(*also, "contact_id", "batch_id", "sent", "opened", "link")
    return spread_join(sent, listed, "contact_id", "inner")


def opt_outs_per_batch(opt_outs: DataFrame, mails: DataFrame) -> DataFrame:
    """Opted-out receivers per mail batch."""
    return (
        opt_out_mails(opt_outs, mails)
        .groupBy("batch_id")
        .agg(
            F.count("contact_id").alias("count"),
            F.min("sent").alias("first_sent"),
            F.max("opened").alias("last_opened"),
        )
    )
