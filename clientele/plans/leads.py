"""The weekly lead lists: who responded, who bought, who to call, text or mail."""

from __future__ import annotations

import secrets
from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.config import (
    DEFAULT_TIME_ZONE,
    LEAD_RANK,
    RESPONSE_RANK,
    SMALL_TICKET_PATTERNS,
    TEXT_MESSAGE_RANK,
)
from clientele.functions.text import (
    as_col,
    is_blank,
    like_any,
    mapped,
    not_blank,
    record_link,
    same_text,
)
from clientele.operators.bitmaps import id_sets, set_sizes
from clientele.operators.hot import hot_keys, spread_join
from clientele.operators.joins import exclude, join_side_table, lookup, suppress
from clientele.operators.pick import top_per_key
from clientele.operators.reshape import union_all
from clientele.plans.contacts import country_group, dial_area

LEAD_COLUMNS = (
    "contact_id",
    "name",
    "what_done",
    "segment",
    "actions",
    "phone",
    "country",
    "seg_country",
    "opty_owner",
    "opty_link",
    "stage",
    "time_city",
    "sent",
    "opened",
    "clicked",
)
# Five-digit numbers start at 10000.
SPREAD = 89999
ROUTE_COLUMNS = (
    "contact_id",
    "name",
    "link",
    "phone",
    "country",
    "what_done",
    "time_zone",
    "cc",
    "opty_owner",
    "opty_link",
    "stage",
)


def current_opportunity(opportunities: DataFrame) -> DataFrame:
    """One opportunity per contact: the last updated, then the highest id.

    Every list below ends with one row per contact, so the choice is made before the
    join rather than after contacts were multiplied by their opportunities.
    """
    order = [F.desc_nulls_last("last_update"), F.desc("opp_id")]
    return top_per_key(opportunities, "contact_id", order)


def _opportunity_columns(opportunities: DataFrame, base_url: str) -> DataFrame:
    return current_opportunity(
        opportunities.select("contact_id", "opp_id", "owner", "stage", "last_update")
    ).select(
        "contact_id",
        F.col("owner").alias("opty_owner"),
        "stage",
        record_link(base_url, "opp_id").alias("opty_link"),
    )


def campaign_responses(
    mail_results: DataFrame,
    batches: DataFrame,
    contacts: DataFrame,
    relabel: dict[str, str] | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Mail results with the batch's template as segment and the contact's details.

    Results of unknown batches or contacts drop out.  ``relabel`` maps a clicked link to
    a segment of its own.
    """
    hot = hot_keys(mail_results, ["contact_id"]) if hot is None else hot
    templated = join_side_table(mail_results, batches, "batch_id", "inner", spread=True)
    templated = templated.withColumnRenamed("template", "segment")
    if relabel:
        templated = templated.withColumn("segment", F.coalesce(mapped("link", relabel), "segment"))
    who = contacts.select("contact_id", "first_name", "last_name", "phone", "country", "city", "email")
    joined = spread_join(templated, who, "contact_id", "inner", hot=hot)
    return joined.withColumn("seg_country", country_group("country")).withColumn(
        "actions", response_segment("phone", "clicked", "seg_country")
    )


def response_segment(
    phone: Column | str, clicked: Column | str, group: Column | str
) -> Column:
    """seg1 no phone; seg2/seg3 international opened/clicked; seg4/seg5 domestic opened/clicked."""
    did_click = as_col(clicked).isNotNull()
    group = as_col(group)
    return (
        F.when(is_blank(phone), "seg1")
        .when(group == "International", F.when(did_click, "seg3").otherwise("seg2"))
        .when(group == "Domestic", F.when(did_click, "seg5").otherwise("seg4"))
        .otherwise("unclassified")
    )


def segment_counts(responses: DataFrame) -> DataFrame:
    """Rows and different contacts per segment class."""
    return responses.groupBy("actions").agg(
        F.count("contact_id").alias("ct"), F.countDistinct("contact_id").alias("contacts")
    )


def responders_by_week(responses: DataFrame, week: str = "week") -> DataFrame:
    """Different contacts per week, template and segment class."""
    return responses.groupBy(week, "segment", "actions").agg(
        F.countDistinct("contact_id").alias("contacts")
    )


def responder_sets(responses: DataFrame, day: str = "sent") -> DataFrame:
    """Who responded, as sets of contacts per day, template and segment class.

    Kept with a day's snapshot they answer later questions without the responses: see
    ``segment_counts_of`` and ``responders_of``.
    """
    return id_sets(responses, [day, "segment", "actions"], "contact_id")


def segment_counts_of(sets: DataFrame) -> DataFrame:
    """``segment_counts`` of all days whose sets are given."""
    return set_sizes(sets, "actions", "contacts", "ct")


def responders_of(sets: DataFrame, window: str) -> DataFrame:
    """Different contacts per window, template and segment class; ``window`` is a column of the
    sets such as a week, a month or a number of days."""
    return set_sizes(sets, [window, "segment", "actions"], "contacts")


def segment_exclusive_contacts(responses: DataFrame, segment: str) -> DataFrame:
    """Contacts that responded to one segment and to no other."""
    return (
        responses.groupBy("contact_id")
        .agg(
            F.min(F.lower("segment")).alias("_lo"),
            F.max(F.lower("segment")).alias("_hi"),
            F.count("*").alias("responses"),
        )
        .filter((F.col("_lo") == segment.lower()) & (F.col("_hi") == segment.lower()))
        .select("contact_id", "responses")
    )


def attach_opportunity(
    leads: DataFrame, opportunities: DataFrame, base_url: str, hot: DataFrame | None = None
) -> DataFrame:
    """Owner, stage and link of each contact's current opportunity.

    It depends on the contact alone, so a list of leads gets it once, when it is down to the
    best ones.  ``hot`` may name the contacts with very many leads, see ``spread_join``.
    """
    return spread_join(leads, _opportunity_columns(opportunities, base_url), "contact_id", "left", hot=hot)


def call_leads(
    responses: DataFrame,
    opportunities: DataFrame | None = None,
    base_url: str = "",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Responders to call (seg3 and seg5) with their dial area and, if given, opportunity."""
    chosen = responses.filter(F.col("actions").isin("seg3", "seg5"))
    if opportunities is not None:
        chosen = attach_opportunity(chosen, opportunities, base_url, hot)
    return chosen.withColumn("time_city", dial_area("phone", "country", "city"))


def cohort_segments(responses: DataFrame, segment: str) -> DataFrame:
    """Contacts that responded to one segment (such as a relabelled link) with the number of
    different segments they responded to."""
    return (
        responses.groupBy("contact_id")
        .agg(
            F.countDistinct("segment").alias("ct"),
            F.max(F.coalesce(same_text("segment", segment), F.lit(False))).alias("_in"),
        )
        .filter("_in")
        .drop("_in")
    )


def purchase_leads(
    purchases: DataFrame,
    opportunities: DataFrame | None = None,
    time_zones: DataFrame | None = None,
    base_url: str = "",
    patterns: Iterable[str] = SMALL_TICKET_PATTERNS,
    low: int = 1,
    high: int = 300,
) -> DataFrame:
    """Buyers of listed products for a small amount, one row per contact (the largest), with
    their time zone and opportunity, where these tables are given."""
    wanted = purchases.filter(like_any("product", patterns) & F.col("invoice").between(low, high))
    best = top_per_key(wanted, "contact_id", [F.desc("invoice"), "inv_id"])
    placed = best.withColumn("seg_country", country_group("country")).withColumn(
        "time_city", dial_area("phone", "country", layout="before_paren", unknown_is_domestic=True)
    )
    if time_zones is not None:
        placed = lookup(placed, time_zones, "time_city", "city")
    if opportunities is not None:
        # One row per contact is left on both sides.
        placed = placed.join(_opportunity_columns(opportunities, base_url), "contact_id", "left")
    return placed


def unify_leads(
    responders: DataFrame, buyers: DataFrame, birthdays: DataFrame | None = None
) -> DataFrame:
    """Responders, buyers and birthdays as one list with common columns."""
    full_name = F.concat("first_name", F.lit(" "), "last_name")
    parts = [
        responders.withColumn("name", full_name).withColumnRenamed("link", "what_done"),
        buyers.withColumnRenamed("product", "what_done")
        .withColumn("segment", F.lit("purchase"))
        .withColumn("actions", F.when(F.col("seg_country") == "Domestic", "seg5").otherwise("seg3")),
    ]
    if birthdays is not None:
        parts.append(birthdays)
    cut = [p.select(*(c for c in LEAD_COLUMNS if c in p.columns)) for p in parts]
    united = union_all(*cut)
    return united.select(*(c for c in LEAD_COLUMNS if c in united.columns))


def add_lead_rank(leads: DataFrame, ranks: dict[str, int] = LEAD_RANK, by: str = "segment") -> DataFrame:
    """Rank of the lead's class; unknown classes have none."""
    return leads.withColumn("rank", mapped(by, ranks))


def split_new_old(leads: DataFrame, week_start: date) -> DataFrame:
    """Type New for this week's mails, purchases and birthdays, Old for earlier mails.

    A lead that is neither (no date and no such class) drops out.
    """
    return leads.withColumn("type", _kind(week_start)).filter(F.col("type").isNotNull())


def _kind(week_start: date) -> Column:
    always = F.coalesce(same_text("segment", "purchase", "DOB"), F.lit(False))
    return F.when(always | (F.col("sent") >= F.lit(week_start)), "New").when(F.col("sent") < F.lit(week_start), "Old")


def best_lead_per_contact(leads: DataFrame) -> DataFrame:
    """The highest-ranked lead of each contact, once among New and once among Old leads.

    Ties go to the latest mail, then to what was done.  Leads without a rank drop out.
    """
    order = [
        F.desc("rank"),
        F.desc_nulls_last("sent"),
        F.asc_nulls_last("what_done"),
        F.asc_nulls_last("clicked"),
        F.asc_nulls_last("opened"),
    ]
    return top_per_key(leads.filter(F.col("rank").isNotNull()), ["type", "contact_id"], order)


def attach_time_zone(
    leads: DataFrame, time_zones: DataFrame, default: str = DEFAULT_TIME_ZONE
) -> DataFrame:
    """Country code and time zone by dial area; domestic leads get a default zone."""
    zoned = lookup(leads, time_zones, "time_city", "city")
    unknown = F.when(F.col("seg_country") == "Domestic", default)
    return zoned.withColumn("time_zone", F.coalesce("time_zone", unknown))


def suppress_no_call(leads: DataFrame, no_call: DataFrame) -> DataFrame:
    """Leave out contacts that are on the no-call list with a reason."""
    return suppress(leads, no_call, "contact_id", "id", "reason")


def do_not_send_until(requests: DataFrame, months: int = 6) -> DataFrame:
    """Last day on which a contact who asked for quiet is left alone."""
    return requests.withColumn("dont_sent_until", F.add_months("date", months))


def route_leads(leads: DataFrame, base_url: str) -> DataFrame:
    """Who works the lead: auto (domestic), manual (international) or awakened (open deal)."""
    closed = F.col("stage").isNull() | same_text("stage", "Won", "Lost")
    route = (
        F.when(closed & (F.col("seg_country") == "Domestic"), "auto")
        .when(closed & (F.col("seg_country") == "International"), "manual")
        .when(same_text("stage", "Working", "New"), "awakened")
    )
    linked = leads.withColumn("link", record_link(base_url, "contact_id"))
    return linked.withColumn("route", route).filter(F.col("route").isNotNull())


def route_list(routed: DataFrame, route: str) -> DataFrame:
    """One of the three call lists."""
    return routed.filter(F.col("route") == route).select(*ROUTE_COLUMNS)


# ---- all lists from one frame ----------------------------------------------------------


def all_responders(responses: DataFrame) -> DataFrame:
    """Responders of every class with their dial area, for ``contact_lists``."""
    return responses.withColumn("time_city", dial_area("phone", "country", "city"))


def contact_lists(
    leads: DataFrame,
    week_start: date,
    ranks: dict[str, int] = LEAD_RANK,
    text_ranks: dict[str, int] = TEXT_MESSAGE_RANK,
) -> DataFrame:
    """Each contact's best candidate for every list, one row per contact.

    ``leads`` holds the candidates of all lists in one frame: responders of every class, buyers
    and birthdays as ``unify_leads`` has them.  ``new`` and ``old`` are the leads to call, chosen
    as ``best_lead_per_contact`` does; ``text`` the best answer to text back (seg4), ``mail`` the
    best of those only mailed (seg1, seg2, seg4).  One aggregate, combined before it is shuffled,
    makes the choice for all of them, so the inputs are read once whatever lists are made.
    """
    ranked = add_lead_rank(leads, ranks).withColumns(
        {"type": _kind(week_start), "_text": mapped("segment", text_ranks), "_mail": mapped("actions", RESPONSE_RANK)}
    )
    last = lambda c: (F.col(c).isNull(), F.col(c))
    order = F.struct(
        -F.col("rank"), F.col("sent").isNull(), -F.unix_date("sent"), *last("what_done"), *last("clicked"), *last("opened")
    )
    lead = F.struct(order.alias("order"), F.struct(*leads.columns, "rank", "type").alias("lead"))
    to_call = F.col("actions").isin("seg3", "seg5") & F.col("rank").isNotNull()
    best = lambda wanted, row: F.min(F.when(wanted, row))
    texted = (F.col("actions") == "seg4") & F.col("_text").isNotNull()
    return ranked.groupBy("contact_id").agg(
        best(to_call & (F.col("type") == "New"), lead)["lead"].alias("new"),
        best(to_call & (F.col("type") == "Old"), lead)["lead"].alias("old"),
        best(texted, F.struct((-F.col("_text")).alias("order"), "segment", "phone")).alias("text"),
        best(
            F.col("actions").isin("seg1", "seg2", "seg4"), F.struct((-F.col("_mail")).alias("order"), "segment", "actions")
        ).alias("mail"),
    )


def leads_to_call(lists: DataFrame) -> DataFrame:
    """The New and the Old lead of each contact as rows, from ``contact_lists``."""
    return lists.select(F.explode(F.array_compact(F.array("new", "old"))).alias("lead")).select("lead.*")


def _without_quiet(lists: DataFrame, no_call: DataFrame) -> DataFrame:
    """The lists with the leads to call emptied for contacts on the no-call list with a reason."""
    quiet = no_call.filter(F.col("reason").isNotNull()).select(F.col("id").alias("contact_id")).distinct()
    marked = lists.join(quiet.withColumn("_quiet", F.lit(True)), "contact_id", "left")
    return marked.withColumns({c: F.when(F.col("_quiet").isNull(), F.col(c)) for c in ("new", "old")}).drop("_quiet")


def _first_of(best: Column, others: list[Column]) -> Column:
    """The smallest of some structs with an order; those that are NULL or have none are out."""
    there = F.filter(F.array(best, *others), lambda x: x["order"].isNotNull())
    return F.array_min(there)


def text_message_list(
    lists: DataFrame,
    no_call: DataFrame,
    opportunities: DataFrame,
    contacts: DataFrame,
    due_from: date,
    ranks: dict[str, int] = TEXT_MESSAGE_RANK,
) -> DataFrame:
    """Domestic contacts to text, best class each, unless all their deals are due later.

    A contact stays when it has no opportunity or one that is due before ``due_from``.  ``lists``
    comes from ``contact_lists``.
    """
    later = F.coalesce(F.col("next_action_date") >= F.lit(due_from), F.lit(False))
    busy = (
        opportunities.groupBy("contact_id").agg(F.bool_and(later).alias("_later")).filter("_later")
    )

    def called(c: str) -> Column:
        row = F.struct((-mapped(F.col(c)["segment"], ranks)).alias("order"), F.col(c)["segment"].alias("segment"), F.col(c)["phone"].alias("phone"))
        return F.when(F.col(c)["actions"] == "seg5", row)

    best = _without_quiet(lists, no_call).select(
        "contact_id", _first_of(F.col("text"), [called("new"), called("old")]).alias("best")
    )
    kept = exclude(best.filter(F.col("best").isNotNull()), busy, "contact_id").select(
        "contact_id", "best.segment", "best.phone", (-F.col("best.order")).alias("rank")
    )
    return join_side_table(kept, contacts.select("contact_id", "first_name"), "contact_id")


def mail_blast_list(
    lists: DataFrame, no_call: DataFrame, seed: int | None = None, random: bool = False
) -> DataFrame:
    """Everyone to invite, best class each, with a five-digit number per contact.

    The number is derived from the contact id and ``seed``.  With ``random`` it is drawn: by a
    hash of the contact id and ``seed``, or of a number drawn for this list where no seed is given.
    Either way a task that runs again gives the same one.  ``lists`` comes from ``contact_lists``.
    """

    def called(c: str) -> Column:
        lead = F.col(c)
        return F.struct((-mapped(lead["actions"], RESPONSE_RANK)).alias("order"), lead["segment"].alias("segment"), lead["actions"].alias("actions"))

    best = (
        _without_quiet(lists, no_call)
        .select("contact_id", _first_of(F.col("mail"), [called("new"), called("old")]).alias("best"))
        .filter(F.col("best").isNotNull())
        .select("contact_id", "best.segment", "best.actions", (-F.col("best.order")).alias("rank"))
    )
    return best.withColumn("num", drawn_number("contact_id", seed) if random else stepped_number("contact_id", seed or 0))


def drawn_number(key: str, seed: int | None = None) -> Column:
    """A five-digit number drawn for each key: the same for a key whatever task computes it."""
    drawn = secrets.randbits(63) if seed is None else seed
    return F.pmod(F.xxhash64(F.lit(drawn).cast("long"), key), F.lit(SPREAD)) + 10000


def stepped_number(key: str, seed: int) -> Column:
    return ((F.pmod(key, F.lit(SPREAD)) * 48271 + seed) % SPREAD + 10000).cast("long")


def with_phone(df: DataFrame) -> DataFrame:
    return df.filter(not_blank("phone"))
