"""Mails, responses, lead lists and revenue per mail."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from clientele.operators.hot import hot_keys, spread_join
from clientele.plans import attribution, contacts, leads
from clientele.sources import tables
from workload.registry import (
    any_area,
    area_or_place,
    blank,
    domestic,
    group_of,
    nb,
    query,
    rounded,
    week,
)

BASE = "https://crm.example/record?id="
WEEK_START = date(2024, 1, 15)
DUE_FROM = date(2001, 7, 1)

# ---- mails ----------------------------------------------------------------------------


@query("""
SELECT contact_id, count(opened) AS num_opened, count(clicked) AS num_clicked
FROM {mail_activity} WHERE opened IS NOT NULL GROUP BY contact_id""")
def q_activity_counts(i):
    return contacts.activity_counts(i.mail_activity)


@query("""
SELECT contact_id, count(*) FILTER (opened > DATE '2024-01-20') AS num_opened,
  count(*) FILTER (clicked > DATE '2024-01-20') AS num_clicked
FROM {mail_activity} WHERE opened IS NOT NULL GROUP BY contact_id""")
def q_activity_after(i):
    return contacts.activity_counts(i.mail_activity, after=date(2024, 1, 20))


@query("""
SELECT DISTINCT mail_id, CAST(unnest(generate_series(date, date + 3, INTERVAL 1 DAY)) AS DATE) AS datecol
FROM {broadcasts}""")
def q_mail_dates(i):
    return attribution.mail_window_days(i.broadcasts)


_SENT_PAIRS = """
SELECT p.*, count(mail_id) OVER (PARTITION BY inv_id) AS n FROM (
  SELECT v.inv_id, v.inv_total, m.mail_id, m.template
  FROM {mail_invoices} AS v LEFT JOIN (
    SELECT DISTINCT s.contact_id, s.mail_id, b.date + 3 AS last_date, b.template
    FROM {sends} AS s JOIN {broadcasts} AS b ON b.mail_id = s.mail_id) AS m
  ON m.contact_id = v.contact_id AND m.last_date >= v.date) AS p"""
_OPEN_PAIRS = """
SELECT p.*, count(mail_id) OVER (PARTITION BY inv_id) AS n FROM (
  SELECT v.inv_id, v.inv_total, m.mail_id, m.template
  FROM {mail_invoices} AS v LEFT JOIN (
    SELECT o.contact_id, o.mail_id, b.template, min(o.opened) AS opened
    FROM {opens} AS o JOIN {broadcasts} AS b ON b.mail_id = o.mail_id WHERE o.mail_id <> 0 GROUP BY 1, 2, 3) AS m
  ON m.contact_id = v.contact_id AND v.date BETWEEN m.opened AND m.opened + 3) AS p"""
_CREATIVE = (
    "(template ILIKE '%ivs%' OR template ILIKE '%bcm%' OR template ILIKE '%lsi%' OR template ILIKE '%wsm%')"
)


def _creative(pairs: str) -> str:
    """The pairs of advertising mails, with n counted among them alone."""
    return (
        "SELECT inv_id, inv_total, mail_id, template, count(mail_id) OVER (PARTITION BY inv_id) AS n "
        f"FROM (SELECT inv_id, inv_total, mail_id, template FROM ({pairs}) AS a WHERE {_CREATIVE}) AS c"
    )


def _per_mail(pairs: str) -> str:
    return f"""
SELECT mail_id, count(inv_id) AS num_sale, round(sum(CAST(1 AS DOUBLE) / nullif(n, 0)), 6) AS effect_sales,
  round(sum(CAST(inv_total AS DOUBLE) / nullif(n, 0)), 6) AS earned
FROM ({pairs}) AS x GROUP BY mail_id"""


def _tidy(df):
    return rounded(df, "effect_sales", "earned")


def _tidy_both(df):
    return rounded(_tidy(df), "adv_effect_sales", "adv_earned")


@query(f"""
SELECT r.*, v.num_deliv, round(r.earned / v.num_deliv, 4) AS earned_over_deliv FROM ({_per_mail(_SENT_PAIRS)}) AS r
LEFT JOIN (SELECT mail_id, count(*) AS num_deliv FROM {{sends}} GROUP BY 1) AS v ON v.mail_id = r.mail_id""")
def q_revenue_by_sent(i):
    result = _tidy(attribution.revenue_by_sent(i.mail_invoices, i.sends, i.broadcasts))
    volume = attribution.rows_per_mail(i.sends, "num_deliv")
    rated = attribution.with_rate(result, volume, "num_deliv", "earned_over_deliv")
    return rounded(rated, "earned_over_deliv", digits=4)


@query(f"""
SELECT r.*, v.num_opened, round(r.earned / v.num_opened, 4) AS earned_over_open FROM ({_per_mail(_OPEN_PAIRS)}) AS r
LEFT JOIN (SELECT mail_id, count(*) AS num_opened FROM {{opens}} GROUP BY 1) AS v ON v.mail_id = r.mail_id""")
def q_revenue_by_open(i):
    result = _tidy(attribution.revenue_by_open(i.mail_invoices, i.opens))
    volume = attribution.rows_per_mail(i.opens, "num_opened")
    rated = attribution.with_rate(result, volume, "num_opened", "earned_over_open")
    return rounded(rated, "earned_over_open", digits=4)


def _creative_sent(i):
    return attribution.revenue_by_sent(
        i.mail_invoices, i.sends, attribution.creative_mails(i.broadcasts), keep_unattributed=False
    )


def _creative_open(i):
    opens = attribution.creative_opens(i.opens, i.broadcasts)
    return attribution.revenue_by_open(i.mail_invoices, opens, keep_unattributed=False)


@query(f"""
SELECT 'sent' AS side, * FROM ({_per_mail(_creative(_SENT_PAIRS))}) AS s
UNION ALL SELECT 'open' AS side, * FROM ({_per_mail(_creative(_OPEN_PAIRS))}) AS o""")
def q_creative_subset(i):
    sent = _tidy(_creative_sent(i)).withColumn("side", F.lit("sent"))
    return sent.unionByName(_tidy(_creative_open(i)).withColumn("side", F.lit("open")))


@query(f"""
SELECT * FROM ({_per_mail(_creative(_SENT_PAIRS).replace(_CREATIVE, f"mail_id IS NOT NULL AND NOT coalesce({_CREATIVE}, FALSE)"))}) AS s""")
def q_other_subset(i):
    other = attribution.creative_mails(i.broadcasts, advertising=False)
    return _tidy(attribution.revenue_by_sent(i.mail_invoices, i.sends, other, keep_unattributed=False))


def _card(pairs: str, volumes: dict[str, str], rate_on: str, rate: str) -> str:
    joins = " ".join(
        f"LEFT JOIN (SELECT mail_id, count(*) AS {name} FROM {table} GROUP BY 1) AS {name}_t "
        f"ON {name}_t.mail_id = a.mail_id"
        for name, table in volumes.items()
    )
    return f"""
SELECT a.mail_id, {", ".join(f"{name}_t.{name}" for name in volumes)},
  a.num_sale AS all_num_sale, a.effect_sales AS all_effect_sales, a.earned AS all_earned,
  c.num_sale AS adv_num_sale, c.effect_sales AS adv_effect_sales, c.earned AS adv_earned,
  round(a.earned / {rate_on}_t.{rate_on}, 4) AS all_{rate}, round(c.earned / {rate_on}_t.{rate_on}, 4) AS adv_{rate}
FROM ({_per_mail(pairs)}) AS a LEFT JOIN ({_per_mail(_creative(pairs))}) AS c ON c.mail_id = a.mail_id {joins}"""


@query(_card(_SENT_PAIRS, {"num_deliv": "{sends}"}, "num_deliv", "per_deliv"))
def q_scorecard_sent(i):
    both = attribution.both_by_sent(i.mail_invoices, i.sends, i.broadcasts)
    volumes = [attribution.rows_per_mail(i.sends, "num_deliv")]
    card = attribution.mail_scorecard(_tidy_both(both), volumes, "num_deliv", "per_deliv")
    return rounded(card, "all_per_deliv", "adv_per_deliv", digits=4)


@query(_card(_OPEN_PAIRS, {"num_opened": "{opens}", "num_deliv": "{sends}"}, "num_opened", "per_open"))
def q_scorecard_open(i):
    both = attribution.both_by_open(i.mail_invoices, i.opens, i.broadcasts)
    volumes = [
        attribution.rows_per_mail(i.opens, "num_opened"),
        attribution.rows_per_mail(i.sends, "num_deliv"),
    ]
    card = attribution.mail_scorecard(_tidy_both(both), volumes, "num_opened", "per_open")
    return rounded(card, "all_per_open", "adv_per_open", digits=4)


@query("""
SELECT DISTINCT m.event_id, m.contact_id, m.batch_id, m.sent, m.opened, m.link, o.type
FROM {mail_activity} AS m JOIN {opt_outs} AS o ON o.contact_id = m.contact_id""")
def q_opt_out(i):
    # The event id keeps equal mails of one contact apart in the comparison.
    return contacts.opt_out_mails(i.opt_outs, i.mail_activity, "event_id")


@query("""
SELECT m.batch_id, count(*) AS count, min(m.sent) AS first_sent, max(m.opened) AS last_opened
FROM {mail_activity} AS m JOIN (SELECT DISTINCT contact_id, type FROM {opt_outs}) AS o ON o.contact_id = m.contact_id
GROUP BY m.batch_id""")
def q_opt_out_batches(i):
    return contacts.opt_outs_per_batch(i.opt_outs, i.mail_activity)


# ---- responses ------------------------------------------------------------------------

_RESPONSES = f"""
SELECT m.event_id, m.contact_id, m.batch_id, m.sent, m.opened, m.clicked, m.link,
  CASE m.link WHEN '/p/3' THEN 'inner' ELSE b.template END AS segment,
  c.first_name, c.last_name, c.phone, c.country, c.city, c.email, {group_of("c.country")} AS seg_country,
  CASE WHEN {blank("c.phone")} THEN 'seg1'
    WHEN {domestic("c.country")} THEN CASE WHEN m.clicked IS NULL THEN 'seg4' ELSE 'seg5' END
    ELSE CASE WHEN m.clicked IS NULL THEN 'seg2' ELSE 'seg3' END END AS actions
FROM {{mail_activity}} AS m JOIN {{mail_batches}} AS b ON b.batch_id = m.batch_id
JOIN {{contacts}} AS c ON c.contact_id = m.contact_id"""
_OPP = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY last_update DESC, opp_id DESC) AS rn
  FROM {opportunities}) AS o WHERE rn = 1"""


def _hot(i):
    return hot_keys(i.mail_activity, ["contact_id"])


def _responses(i):
    return leads.campaign_responses(
        i.mail_activity, i.mail_batches, i.contacts, relabel={"/p/3": "inner"}, hot=_hot(i)
    )


@query(_RESPONSES)
def q_responses(i):
    return _responses(i)


@query(f"""
SELECT event_id, contact_id, seg_country, actions FROM ({_RESPONSES}) AS r""")
def q_response_segment(i):
    return _responses(i).select("event_id", "contact_id", "seg_country", "actions")


@query(f"""
SELECT actions, count(*) AS ct, count(DISTINCT contact_id) AS contacts FROM ({_RESPONSES}) AS r GROUP BY actions""")
def q_segment_counts(i):
    return leads.segment_counts(_responses(i))


def _responder_sets(i):
    """Written once, as a day's snapshot keeps them."""
    path = tables.new_table_path(i.spark, "responder-sets")
    return tables.save(leads.responder_sets(_responses(i)), path)


@query(f"""
SELECT actions, count(*) AS ct, count(DISTINCT contact_id) AS contacts FROM ({_RESPONSES}) AS r GROUP BY actions""")
def q_segment_counts_sets(i):
    return leads.segment_counts_of(_responder_sets(i))


@query(f"""
SELECT {week("sent")} AS week, segment, actions, count(DISTINCT contact_id) AS contacts
FROM ({_RESPONSES}) AS r GROUP BY 1, 2, 3""")
def q_responders_by_week_sets(i):
    from clientele.plans.calendar import label_weeks

    return leads.responders_of(label_weeks(_responder_sets(i), "sent", "week"), "week")


@query(f"""
SELECT CAST(date_trunc('month', sent) AS DATE) AS month, segment, actions, count(DISTINCT contact_id) AS contacts
FROM ({_RESPONSES}) AS r GROUP BY 1, 2, 3""")
def q_responders_by_month(i):
    months = _responder_sets(i).withColumn("month", F.trunc("sent", "month"))
    return leads.responders_of(months, "month")


@query(f"""
SELECT {week("sent")} AS week, segment, actions, count(DISTINCT contact_id) AS contacts
FROM ({_RESPONSES}) AS r GROUP BY 1, 2, 3""")
def q_responders_by_week(i):
    from clientele.plans.calendar import label_weeks

    return leads.responders_by_week(label_weeks(_responses(i), "sent", "week"))


@query(f"""
SELECT contact_id, count(*) AS responses FROM (
  SELECT contact_id, actions AS segment FROM ({_RESPONSES}) AS r) AS x
GROUP BY contact_id HAVING count(DISTINCT segment) = 1 AND min(segment) = 'seg1'""")
def q_exclusive(i):
    by_class = _responses(i).select("contact_id", F.col("actions").alias("segment"))
    return leads.segment_exclusive_contacts(by_class, "seg1")


@query(f"""
SELECT contact_id, count(DISTINCT segment) AS ct FROM ({_RESPONSES}) AS r GROUP BY contact_id
HAVING bool_or(segment = 'inner')""")
def q_cohort(i):
    return leads.cohort_segments(_responses(i), "inner")


_CALLS = f"""
SELECT r.*, o.owner AS opty_owner, o.stage, '{BASE}' || CAST(o.opp_id AS VARCHAR) AS opty_link,
  {area_or_place("r.phone", "r.country", f"coalesce({nb('r.country')}, {nb('r.city')})")} AS time_city
FROM ({_RESPONSES}) AS r LEFT JOIN ({_OPP}) AS o ON o.contact_id = r.contact_id
WHERE r.actions IN ('seg3', 'seg5')"""


def _call_leads(i):
    return leads.call_leads(_responses(i), i.opportunities, BASE, hot=_hot(i))


@query(_CALLS)
def q_call_leads(i):
    return _call_leads(i)


_BUYERS = f"""
SELECT x.inv_id, x.contact_id, x.name, x.phone, x.country, x.product, x.invoice, x.seg_country, x.time_city, z.cc, z.time_zone,
  o.owner AS opty_owner, o.stage, '{BASE}' || CAST(o.opp_id AS VARCHAR) AS opty_link
FROM (
  SELECT *, {group_of("country")} AS seg_country,
    CASE WHEN ({domestic("country")} OR {blank("country")}) AND NOT {blank("phone")}
      THEN right(split_part(phone, ')', 1), 3) ELSE {nb("country")} END AS time_city,
    row_number() OVER (PARTITION BY contact_id ORDER BY invoice DESC, inv_id) AS rn
  FROM {{purchases}}
  WHERE (product ILIKE 'book%' OR product ILIKE 'ivs%' OR product ILIKE '%dvd%' OR product ILIKE 'online%'
    OR product ILIKE '%vol%' OR product ILIKE '%mini%') AND invoice BETWEEN 1 AND 300) AS x
LEFT JOIN {{time_zones}} AS z ON lower(z.city) = lower(x.time_city)
LEFT JOIN ({_OPP}) AS o ON o.contact_id = x.contact_id
WHERE x.rn = 1"""


def _buyers(i):
    return leads.purchase_leads(i.purchases, i.opportunities, i.time_zones, BASE)


@query(
    f"SELECT * REPLACE (CAST(invoice AS DOUBLE) AS invoice) FROM ({_BUYERS}) AS b"
)
def q_purchase_leads(i):
    return _buyers(i)


_BIRTHDAYS = f"""
SELECT c.contact_id, c.first_name || ' ' || c.last_name AS name, 'Birthday this week' AS what_done, 'DOB' AS segment,
  CASE WHEN {domestic("c.country")} THEN 'seg5' ELSE 'seg3' END AS actions, c.phone, c.country,
  {group_of("c.country")} AS seg_country, o.owner AS opty_owner, '{BASE}' || CAST(o.opp_id AS VARCHAR) AS opty_link,
  o.stage, {area_or_place("c.phone", "c.country", nb("c.country"))} AS time_city
FROM {{contacts}} AS c LEFT JOIN ({_OPP}) AS o ON o.contact_id = c.contact_id
WHERE month(c.dob) = 7 AND day(c.dob) BETWEEN 6 AND 26 AND NOT {blank("c.phone")}"""


def _birthdays(i):
    current = leads.current_opportunity(i.opportunities)
    return contacts.birthday_list(i.contacts, current, (7, 6), (7, 26), BASE)


@query(_BIRTHDAYS)
def q_birthday_list(i):
    return _birthdays(i)


# ---- lead lists -----------------------------------------------------------------------

_UNIFIED = f"""
SELECT contact_id, first_name || ' ' || last_name AS name, link AS what_done, segment, actions, phone, country,
  seg_country, opty_owner, opty_link, stage, time_city, sent, opened, clicked FROM ({_CALLS}) AS a
UNION ALL
SELECT contact_id, name, product, 'purchase', CASE seg_country WHEN 'Domestic' THEN 'seg5' ELSE 'seg3' END, phone,
  country, seg_country, opty_owner, opty_link, stage, time_city, NULL, NULL, NULL FROM ({_BUYERS}) AS b
UNION ALL
SELECT contact_id, name, what_done, segment, actions, phone, country, seg_country, opty_owner, opty_link, stage,
  time_city, NULL, NULL, NULL FROM ({_BIRTHDAYS}) AS d"""
_RANKED = f"""
SELECT *, CAST(CASE lower(segment) WHEN 'purchase' THEN 6 WHEN 'fpc' THEN 5 WHEN 'wsm' THEN 4 WHEN 'dob' THEN 3
  WHEN 'one-off' THEN 2 WHEN 'lsi' THEN 1 WHEN 'curric' THEN 0 END AS BIGINT) AS rank FROM ({_UNIFIED}) AS u"""
_TYPED = f"""
SELECT *, CASE WHEN segment IN ('purchase', 'DOB') OR sent >= DATE '2024-01-15' THEN 'New' ELSE 'Old' END AS type
FROM ({_RANKED}) AS r"""
_BEST = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY type, contact_id ORDER BY rank DESC, sent DESC NULLS LAST,
    what_done NULLS LAST, clicked NULLS LAST, opened NULLS LAST) AS rn
  FROM ({_TYPED}) AS t WHERE rank IS NOT NULL) AS w WHERE rn = 1"""
_ZONED = f"""
SELECT b.*, z.cc, coalesce(z.time_zone, CASE b.seg_country WHEN 'Domestic' THEN 'PST + 3 or PST' END) AS time_zone
FROM ({_BEST}) AS b LEFT JOIN {{time_zones}} AS z ON lower(z.city) = lower(b.time_city)"""
_CALLABLE = f"""
SELECT * FROM ({_ZONED}) AS z
WHERE contact_id NOT IN (SELECT id FROM {{no_call}} WHERE reason IS NOT NULL)"""


def _bare(i):
    """All leads without their opportunities."""
    birthdays = contacts.birthday_list(i.contacts, None, (7, 6), (7, 26))
    return leads.unify_leads(leads.call_leads(_responses(i)), leads.purchase_leads(i.purchases), birthdays)


def _unified(i):
    return leads.attach_opportunity(_bare(i), i.opportunities, BASE).select(*leads.LEAD_COLUMNS)


def _ranked(i):
    return leads.add_lead_rank(_unified(i))


def _typed(i):
    return leads.split_new_old(_ranked(i), WEEK_START)


def _best(i):
    return leads.attach_opportunity(leads.leads_to_call(_lists(i)), i.opportunities, BASE)


def _lists(i):
    """Every contact's candidates of all lists."""
    birthdays = contacts.birthday_list(i.contacts, None, (7, 6), (7, 26))
    everyone = leads.unify_leads(leads.all_responders(_responses(i)), leads.purchase_leads(i.purchases), birthdays)
    return leads.contact_lists(everyone, WEEK_START)


def _callable(i):
    return leads.suppress_no_call(leads.attach_time_zone(_best(i), i.time_zones), i.no_call)


@query(_UNIFIED)
def q_unify_leads(i):
    return _unified(i)


@query(_RANKED)
def q_lead_rank(i):
    return _ranked(i)


@query(_TYPED)
def q_new_old(i):
    return _typed(i)


@query(_BEST)
def q_best_lead(i):
    return _best(i)


@query(_BEST)
def q_best_lead_rows(i):
    """The same choice among rows, for leads that are not kept as one frame."""
    typed = leads.split_new_old(leads.add_lead_rank(_bare(i)), WEEK_START)
    return leads.attach_opportunity(leads.best_lead_per_contact(typed), i.opportunities, BASE)


@query(_ZONED)
def q_time_zone(i):
    return leads.attach_time_zone(_best(i), i.time_zones)


@query(_CALLABLE)
def q_no_call(i):
    return _callable(i)


@query(f"""
SELECT contact_id, name, '{BASE}' || CAST(contact_id AS VARCHAR) AS link, phone, country, what_done, time_zone, cc,
  opty_owner, opty_link, stage,
  CASE WHEN stage IN ('Working', 'New') THEN 'awakened' WHEN seg_country = 'Domestic' THEN 'auto' ELSE 'manual' END
    AS route
FROM ({_CALLABLE}) AS c""")
def q_route_leads(i):
    routed = leads.route_leads(_callable(i), BASE)
    return routed.select(*leads.ROUTE_COLUMNS, "route")


@query(f"""
SELECT contact_id, name, '{BASE}' || CAST(contact_id AS VARCHAR) AS link, phone, country, what_done, time_zone, cc,
  opty_owner, opty_link, stage
FROM ({_CALLABLE}) AS c WHERE seg_country = 'International' AND coalesce(stage, 'Won') IN ('Won', 'Lost')""")
def q_manual_list(i):
    return leads.route_list(leads.route_leads(_callable(i), BASE), "manual")


@query(f"""
SELECT c.contact_id, z.city AS time_city, z.time_zone FROM (
  SELECT contact_id, {any_area("phone")} AS city FROM {{contacts}} WHERE NOT {blank("phone")}) AS c
JOIN {{time_zones}} AS z ON z.city = c.city""")
def q_contact_time_zone(i):
    from clientele.functions.phones import area_code
    from clientele.operators.joins import lookup

    who = leads.with_phone(i.contacts).select("contact_id", area_code("phone").alias("time_city"))
    zones = i.time_zones.select("city", "time_zone")
    return lookup(who, zones, "time_city", "city", how="inner")


@query("""
SELECT event_id, contact_id, date, CAST(date + INTERVAL 6 MONTH AS DATE) AS dont_sent_until FROM {quiet_requests}""")
def q_quiet_until(i):
    return leads.do_not_send_until(i.quiet_requests)


@query(f"""
WITH pool AS (
  SELECT contact_id, segment, phone FROM ({_CALLABLE}) AS c WHERE actions = 'seg5'
  UNION ALL SELECT contact_id, segment, phone FROM ({_RESPONSES}) AS r WHERE actions = 'seg4'),
kept AS (
  SELECT DISTINCT p.contact_id, p.segment, p.phone FROM pool AS p
  LEFT JOIN {{opportunities}} AS o ON o.contact_id = p.contact_id
  WHERE coalesce(o.next_action_date < DATE '2001-07-01', TRUE))
SELECT k.contact_id, k.segment, k.phone, k.rank, c.first_name FROM (
  SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY rank DESC, segment, phone) AS rn FROM (
    SELECT *, CAST(CASE lower(segment) WHEN 'purchase' THEN 6 WHEN 'fpc' THEN 5 WHEN 'wsm' THEN 4 WHEN 'one-off' THEN 3
      WHEN 'lsi' THEN 2 WHEN 'curric' THEN 1 END AS BIGINT) AS rank FROM kept) AS x WHERE rank IS NOT NULL) AS k
LEFT JOIN {{contacts}} AS c ON c.contact_id = k.contact_id WHERE rn = 1""")
def q_sms_list(i):
    return leads.text_message_list(_lists(i), i.no_call, i.opportunities, i.contacts, DUE_FROM)


@query(f"""
WITH pool AS (
  SELECT contact_id, segment, actions FROM ({_CALLABLE}) AS c WHERE actions IN ('seg3', 'seg5')
  UNION ALL SELECT contact_id, segment, actions FROM ({_RESPONSES}) AS r WHERE actions IN ('seg1', 'seg2', 'seg4'))
SELECT contact_id, segment, actions, rank, contact_id % 89999 * 48271 % 89999 + 10000 AS num FROM (
  SELECT *, CAST(right(actions, 1) AS BIGINT) AS rank,
    row_number() OVER (PARTITION BY contact_id ORDER BY right(actions, 1) DESC, segment) AS rn FROM pool) AS x
WHERE rn = 1""")
def q_blast_list(i):
    return leads.mail_blast_list(_lists(i), i.no_call, seed=0)


@query(f"""
WITH pool AS (
  SELECT contact_id, segment, actions FROM ({_CALLABLE}) AS c WHERE actions IN ('seg3', 'seg5')
  UNION ALL SELECT contact_id, segment, actions FROM ({_RESPONSES}) AS r WHERE actions IN ('seg1', 'seg2', 'seg4'))
SELECT contact_id, segment, actions, rank, TRUE AS in_range FROM (
  SELECT *, CAST(right(actions, 1) AS BIGINT) AS rank,
    row_number() OVER (PARTITION BY contact_id ORDER BY right(actions, 1) DESC, segment) AS rn FROM pool) AS x
WHERE rn = 1""")
def q_blast_list_random(i):
    # The number differs from run to run; its range does not.
    drawn = leads.mail_blast_list(_lists(i), i.no_call, seed=7, random=True)
    return drawn.withColumn("in_range", F.col("num").between(10_000, 99_998)).drop("num")
