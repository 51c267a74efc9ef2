"""Opportunities, calls, sales and the world map."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from clientele.config import FINAL_DISPOSITIONS
from clientele.plans import calls, geo, leads, opportunities, sales
from clientele.operators.diff import snapshot_diff
from workload.lead_queries import BASE
from workload.registry import (
    any_area,
    blank,
    cash,
    clock,
    domestic,
    nb,
    percent,
    query,
    slash_date,
    week,
)

WEEK = (date(1998, 6, 1), date(1998, 6, 7))
NEXT_WEEK = (date(1998, 6, 8), date(1998, 6, 14))
REPORT_DAY = date(1998, 6, 8)
OWNER_NAMES = {"Sales Desk": "rep_0"}
LINES = {
    "DESK 1": "rep_1",
    "DESK - 2": "rep_2",
    "DESK 3": "rep_3",
    "CA [DESK 1]": "rep_1",
}
SELLERS = {"0": "rep_1", "1": "rep_2", "2": "rep_3", "3": "rep_4", "4": "rep_5"}
SELLER_CODES = list(SELLERS.values())
PIVOT_DAYS = [date(2024, 1, 1) + timedelta(days=n) for n in range(7)]

# Invented staffing: rounds each caller dials and how many touched ones are enough, the calls
# each should make a day, and the days each works.
DIAL_SCHEDULE = {
    "rep_1": ((1, 2), 2),
    "rep_2": ((1, 2, 3, 4), 3),
    "rep_3": ((3, 4, 5), 2),
    "rep_4": ((2, 5), 1),
}
CALL_TARGET = {"rep_1": 40, "rep_2": 25, "rep_3": 60, "rep_4": 50}
CALL_SHIFT = {
    "rep_1": ("Monday", "Tuesday"),
    "rep_2": ("Monday", "Saturday"),
    "rep_3": ("Thursday", "Friday", "Saturday"),
    "rep_4": ("Tuesday", "Wednesday", "Sunday"),
}
# Invented amounts: where a sale counts as large, and prices that count apart.
BIG_TICKET = 20_000
SMALL_AMOUNTS = ("297", "0.25", "997", "450")

# ---- snapshots ------------------------------------------------------------------------


@query("""
SELECT a.wsid, a.description AS event_info, 'Removed' AS change_type
FROM {event_list_old} AS a WHERE a.wsid NOT IN (SELECT wsid FROM {event_list_new})
UNION ALL
SELECT b.wsid, b.description, 'Added' FROM {event_list_new} AS b WHERE b.wsid NOT IN (SELECT wsid FROM {event_list_old})
UNION ALL
SELECT a.wsid, a.description || '-->' || b.description, 'Update'
FROM {event_list_old} AS a JOIN {event_list_new} AS b ON a.wsid = b.wsid WHERE a.description <> b.description""")
def q_snapshot_diff(i):
    return snapshot_diff(i.event_list_old, i.event_list_new, "wsid", "description")


@query("""
SELECT wsid, description, ws_date, date_diff('day', DATE '2001-01-01', ws_date) AS days_away FROM {event_list_new}""")
def q_days_away(i):
    return opportunities.days_away(i.event_list_new, "ws_date", date(2001, 1, 1))


# ---- opportunities --------------------------------------------------------------------


@query(f"""
SELECT o.opp_id, o.contact_id, CASE o.owner WHEN 'Sales Desk' THEN 'rep_0' ELSE o.owner END AS owner, o.stage,
  {slash_date("o.next_action_date")} AS next_action_date, {slash_date("o.date_create")} AS date_create,
  {slash_date("o.last_update")} AS last_update, c.country
FROM {{opportunities_staged}} AS o LEFT JOIN {{contacts}} AS c ON c.contact_id = o.contact_id""")
def q_opportunity_clean(i):
    return opportunities.clean_opportunities(i.opportunities_staged, i.contacts, OWNER_NAMES)


@query("""
SELECT a.opp_id, b.next_action_date AS old_next_action_date, a.next_action_date, TRUE AS moved,
  date_diff('day', b.next_action_date, a.next_action_date) AS days_moved
FROM {opportunities} AS a JOIN {opportunities_before} AS b ON b.opp_id = a.opp_id
WHERE a.next_action_date <> b.next_action_date""")
def q_opportunity_moved(i):
    return opportunities.moved_opportunities(i.opportunities, i.opportunities_before)


def _report_branch(kind: str, where: str, action: str, week_no: str, moved: bool = False) -> str:
    def text(c: str) -> str:
        now = f"CAST(a.{c} AS VARCHAR)"
        return f"CAST(b.{c} AS VARCHAR) || '--->' || {now}" if moved else now

    join = "JOIN {opportunities_before} AS b ON b.opp_id = a.opp_id" if moved else ""
    return f"""
SELECT '{week_no}' AS week_number, '{BASE}' || CAST(a.opp_id AS VARCHAR) AS opty_link, a.opp_id, a.owner, a.contact_id,
  a.contact_name, a.phone_number, a.city, a.state, a.country, {text("opp")} AS opty_description,
  {text("next_action_date")} AS next_action_text, {action} AS action, '{kind}' AS type, {text("stage")} AS working_stage,
  {text("loss_reason")} || ' | ' || {text("order_revenue")} AS result
FROM {{opportunities}} AS a {join} WHERE {where}"""


_IN_WEEK = "BETWEEN DATE '1998-06-01' AND DATE '1998-06-07'"
_BOTH = "a.next_action || ' | ' || a.note"
_REPORT = " UNION ALL ".join([
    _report_branch("New", f"a.date_create {_IN_WEEK}", _BOTH, "W23"),
    _report_branch("Addressed", f"a.next_action_date {_IN_WEEK} AND a.stage IN ('Won', 'Lost')", "a.note", "W23"),
    _report_branch(
        "Addressed",
        "a.next_action_date <> b.next_action_date AND a.stage = 'Working' AND a.next_action_date > DATE '1998-06-07'",
        _BOTH, "W23", moved=True,
    ),
    _report_branch("Not addressed", f"a.next_action_date {_IN_WEEK} AND a.last_update NOT {_IN_WEEK}", _BOTH, "W23"),
    _report_branch(
        "Will address", "a.next_action_date BETWEEN DATE '1998-06-08' AND DATE '1998-06-14'", _BOTH, "W24"
    ),
])


def _report(i):
    return opportunities.opportunity_week_report(
        i.opportunities, i.opportunities_before, WEEK, NEXT_WEEK, REPORT_DAY, BASE
    )


@query(_REPORT)
def q_opportunity_week(i):
    return _report(i)


@query(f"""
SELECT opp_id, contact_id, contact_name, '{BASE}' || CAST(contact_id AS VARCHAR) AS link, phone_number, country,
  action AS what_done, owner, opty_link, working_stage, type,
  CASE WHEN {domestic("country")} OR {blank("country")}
    THEN CASE WHEN left(phone_number, 1) = '1' THEN substring(phone_number, 4, 3) ELSE substring(phone_number, 2, 3) END
    ELSE country END AS time_city
FROM ({_REPORT}) AS r WHERE type IN ('Will address', 'Not addressed') AND NOT {blank("phone_number")}
  AND regexp_matches(phone_number, '^.[0-9]')""")
def q_live_calls(i):
    return opportunities.live_opportunity_calls(_report(i), BASE)


@query(f"""
SELECT owner, type, count(*) AS count FROM ({_REPORT}) AS r WHERE owner <> 'rep_3' GROUP BY owner, type""")
def q_opportunity_activity(i):
    return opportunities.opportunity_activity(_report(i), without_owner="rep_3")


@query("""
WITH pairs AS (
  SELECT b.contact_id, b.name, b.date AS booked, b.provider, o.opp_id, o.owner, o.date_create, o.last_update, o.stage
  FROM {bookings} AS b JOIN {opportunities} AS o ON o.contact_id = b.contact_id)
SELECT * EXCLUDE (rn), 'May be updated' AS type FROM (
  SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY last_update DESC, opp_id DESC, booked, name) AS rn
  FROM pairs WHERE last_update > booked AND provider = owner) AS u WHERE rn = 1
UNION ALL
SELECT * EXCLUDE (rn), 'Created' AS type FROM (
  SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY date_create DESC, opp_id DESC, booked, provider, name) AS rn
  FROM pairs WHERE date_create > booked) AS c WHERE rn = 1""")
def q_consult_match(i):
    return opportunities.consult_to_opportunity(i.bookings, i.opportunities)


@query("""
SELECT b.event_id, b.contact_id, b.date, b.provider, b.name, o.owner, o.opp_id, o.note, o.phone_number AS opty_phone
FROM {bookings} AS b LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY last_update DESC, opp_id DESC) AS rn
  FROM {opportunities}) AS o ON o.contact_id = b.contact_id AND o.rn = 1""")
def q_consult_check(i):
    return opportunities.consult_check(i.bookings, i.opportunities)


@query("""
SELECT contact_id, opp_id, stage FROM (
  SELECT *, row_number() OVER (PARTITION BY contact_id ORDER BY last_update DESC, opp_id DESC) AS rn
  FROM {opportunities}) AS o WHERE rn = 1""")
def q_current_opportunity(i):
    return leads.current_opportunity(i.opportunities).select("contact_id", "opp_id", "stage")


# ---- calls ----------------------------------------------------------------------------

_ATTEMPTS = f"""
SELECT opty_id, caller, date, attempt, dayname(date) AS day_name,
  CAST(CASE caller {" ".join(f"WHEN '{c}' THEN {n}" for c, n in CALL_TARGET.items())} ELSE 0 END AS BIGINT) AS target,
  CASE WHEN {" OR ".join(f"caller = '{c}' AND dayname(date) IN {days}" for c, days in CALL_SHIFT.items())}
    THEN 'Y' ELSE 'N' END AS work
FROM (
  SELECT opty_id, caller_1 AS caller, date_1 AS date, 'call_once' AS attempt FROM {{call_attempts}}
  UNION ALL SELECT opty_id, caller_2, date_2, 'call_twice' FROM {{call_attempts}}
  UNION ALL SELECT opty_id, caller_3, date_3, 'call_three_times' FROM {{call_attempts}}) AS a
WHERE NOT {blank("caller")}"""


@query(_ATTEMPTS)
def q_attempts_long(i):
    return calls.call_attempts_long(i.call_attempts, CALL_TARGET, CALL_SHIFT)


@query(f"""
SELECT caller, date, day_name, target, count(opty_id) AS number_called FROM ({_ATTEMPTS}) AS a GROUP BY ALL""")
def q_calls_per_day(i):
    return calls.calls_per_day(calls.call_attempts_long(i.call_attempts, CALL_TARGET, CALL_SHIFT))


def _day_cell(d: date) -> str:
    n = f"count(*) FILTER (date = DATE '{d}')"
    share = percent(f"CAST({n} AS DOUBLE) / nullif(target, 0)")
    return (
        f"CAST({n} AS VARCHAR) || '/' || CAST(target AS VARCHAR) || ' --- ' || {share} AS day_{d:%Y_%m_%d}"
    )


@query(f"""
SELECT caller, {", ".join(_day_cell(d) for d in PIVOT_DAYS)},
  count(*) FILTER (date IS NULL OR date NOT BETWEEN DATE '{PIVOT_DAYS[0]}' AND DATE '{PIVOT_DAYS[-1]}') AS other_days FROM ({_ATTEMPTS}) AS a GROUP BY caller, target""")
def q_call_day_pivot(i):
    return calls.call_day_pivot(calls.call_attempts_long(i.call_attempts, CALL_TARGET, CALL_SHIFT), PIVOT_DAYS)


_D1, _D2, _OUT = (f"NOT {blank(c)}" for c in ("date_1", "date_2", "out_come"))
_FULL = f"(({_D1} AND {_D2}) OR {_OUT})"
_NONE = f"(NOT ({_D1}) AND NOT ({_D2}) AND NOT ({_OUT}))"


@query(f"""
SELECT caller_1, count(*) FILTER ({_FULL}) AS full_address, count(*) FILTER (NOT {_FULL} AND NOT {_NONE})
  AS partly_address, count(*) FILTER ({_NONE}) AS non_address
FROM {{follow_ups}} WHERE NOT {blank("caller_1")} GROUP BY caller_1""")
def q_follow_up(i):
    return calls.follow_up_coverage(i.follow_ups)


@query("""
SELECT r.*, CAST(r.round AS BIGINT) AS round_no, d.kind, d.next_round, d.action
FROM (SELECT * FROM {dial_results}) AS r
JOIN {dispositions} AS d ON lower(trim(r.result)) = lower(trim(d.disposition)) WHERE lower(d.next_round) = 'yes'
""".replace("SELECT r.*, CAST(r.round AS BIGINT) AS round_no", "SELECT r.* REPLACE (CAST(r.round AS BIGINT) AS round)"))
def q_disposition(i):
    return calls.disposition_follow_up(i.dial_results, i.dispositions)


@query(f"""
SELECT caller, day, to_call, calls, opportunities, pick_ups, to_call - calls AS not_called,
  {percent("CAST(pick_ups AS DOUBLE) / nullif(calls, 0)")} AS pick_up_pct
FROM (SELECT caller, day, count(first_name) AS to_call, count(*) FILTER (NOT {blank("result")}) AS calls,
    count(*) FILTER (lower(trim(result)) IN ('interested', 'interested - follow up', 'interested - opty')) AS opportunities,
    count(*) FILTER (NOT {blank("duration")}) AS pick_ups
  FROM {{dial_results}} GROUP BY caller, day) AS s""")
def q_dial_stats(i):
    both = i.dial_results
    return calls.dial_stats(both.filter("day = 'monday'"), both.filter("day = 'tuesday'"))


_FINAL = ", ".join(f"'{d.lower()}'" for d in FINAL_DISPOSITIONS)


def _shown(result: str) -> str:
    return f"(CASE WHEN lower(trim({result})) IN ({_FINAL}) THEN 'no_count' WHEN {blank(result)} THEN '' ELSE {result} END)"


def _rounds_of(caller: str, rounds: tuple[int, ...]) -> str:
    """One caller's wide table by joining the rounds of the schedule one by one."""
    per_round = (
        "(SELECT id, result, caller FROM {dial_results} WHERE round = %d QUALIFY "
        "row_number() OVER (PARTITION BY id ORDER BY result DESC NULLS LAST, caller DESC NULLS LAST) = 1)"
    )
    cols = [
        f"{_shown(f'r{n}.result')} AS result{k + 1}" if n else f"'' AS result{k + 1}"
        for k, n in enumerate([*rounds, *[0] * (WIDTH - len(rounds))])
    ]
    joins = " ".join(
        f"LEFT JOIN {per_round % n} AS r{n} ON r{n}.id = r{rounds[0]}.id" for n in rounds[1:]
    )
    return (
        f"SELECT r{rounds[0]}.id, '{caller}' AS caller, {', '.join(cols)} FROM {per_round % rounds[0]} AS r{rounds[0]} "
        f"{joins} WHERE r{rounds[0]}.caller = '{caller}'"
    )


WIDTH = max(len(rounds) for rounds, _ in DIAL_SCHEDULE.values())
_WIDE = " UNION ALL ".join(_rounds_of(c, rounds) for c, (rounds, _) in DIAL_SCHEDULE.items())
_TOUCHED = " + ".join(f"CAST(result{k} <> '' AS INT)" for k in range(1, WIDTH + 1))
_ENDED = " OR ".join(f"result{k} = 'no_count'" for k in range(1, WIDTH + 1))


@query(_WIDE)
def q_dial_rounds(i):
    return calls.dial_rounds_wide(i.dial_results, DIAL_SCHEDULE)


@query("""
SELECT id, caller, result, CAST(round AS BIGINT) AS round FROM {dial_results} WHERE round IS NOT NULL""")
def q_rounds_long(i):
    of_round = {n: i.dial_results.filter(F.col("round") == n).select("id", "caller", "result") for n in range(1, 6)}
    return calls.rounds_long(of_round)


@query(f"""
SELECT caller, count(DISTINCT id) AS total_request, count(*) FILTER (is_full) AS full_address,
  count(*) FILTER (NOT is_full AND touched > 0) AS partly_address, count(*) FILTER (touched = 0) AS non_address
FROM (SELECT *, {_TOUCHED} AS touched, ({_ENDED}) OR {_TOUCHED} >= CASE caller {" ".join(f"WHEN '{c}' THEN {n}" for c, (_, n) in DIAL_SCHEDULE.items())} END AS is_full
  FROM ({_WIDE}) AS w) AS t GROUP BY caller""")
def q_dial_coverage(i):
    return calls.dial_coverage(calls.dial_rounds_wide(i.dial_results, DIAL_SCHEDULE), DIAL_SCHEDULE)


@query(f"""
SELECT id, caller FROM ({_WIDE}) AS w WHERE {_TOUCHED} = 0""")
def q_never_reached(i):
    return calls.never_reached_list(calls.dial_rounds_wide(i.dial_results, DIAL_SCHEDULE))


@query(f"""
SELECT id, {slash_date("note")} AS note, TRY_CAST(regexp_extract(duration, '^\\s*([0-9]+)', 1) AS BIGINT) AS duration FROM {{auto_list}}""")
def q_auto_list(i):
    return calls.clean_auto_list(i.auto_list)


def _on(*names: str) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return " OR ".join(f"lower(trim(coalesce({c}, ''))) IN ({listed})" for c in ("from_who", "cid_name", "to_whom"))


# The first person found on either side of the call, in the order of the list.
_OWNER = (
    f"CASE WHEN {_on('desk 1', 'ca [desk 1]')} THEN 'rep_1' WHEN {_on('desk - 2')} THEN 'rep_2' "
    f"WHEN {_on('desk 3')} THEN 'rep_3' END"
)


_SECONDS = (
    "CAST(split_part(length, ':', 1) AS BIGINT) * 3600 + CAST(split_part(length, ':', 2) AS BIGINT) * 60 "
    "+ CAST(split_part(length, ':', 3) AS BIGINT)"
)
_OWNED = f"""
SELECT * FROM (
  SELECT id, {slash_date("date")} AS date, length, from_who, cid_name, to_whom,
    {_OWNER} AS owner, {_SECONDS} AS length_sec
  FROM {{call_log}}) AS c WHERE owner IS NOT NULL"""


def _owned(i):
    return calls.call_log_owner(i.call_log, LINES)


@query(f"""
SELECT *, lpad(CAST(length_sec // 3600 AS VARCHAR), 2, '0') || 'h ' || lpad(CAST(length_sec % 3600 // 60 AS VARCHAR), 2, '0')
  || 'm' AS length_hour FROM ({_OWNED}) AS o""")
def q_call_log(i):
    return _owned(i)


def _time_report(by_day: bool) -> str:
    day = ", date" if by_day else ""
    days = "1" if by_day else "count(DISTINCT date)"
    return f"""
SELECT owner, week_number{day}, {clock("sec")} AS total_call_time, number_of_calls, number_day_worked,
  {clock("floor(CAST(sec AS DOUBLE) / number_day_worked)")} AS ave_time_day,
  {clock("target_seconds")} AS bench_mark,
  {percent("CAST(sec AS DOUBLE) / number_day_worked / nullif(CAST(target_seconds AS DOUBLE), 0) - 1")} AS variance
FROM (SELECT owner, {week("date")} AS week_number{day}, sum(length_sec) AS sec, count(id) AS number_of_calls,
    CAST({days} AS BIGINT) AS number_day_worked
  FROM ({_OWNED}) AS o GROUP BY owner, week_number{day}) AS s
LEFT JOIN {{call_targets}} AS t ON t.caller = s.owner"""


@query(_time_report(by_day=False))
def q_phone_time(i):
    return calls.phone_time_report(_owned(i), i.call_targets)


@query(_time_report(by_day=True))
def q_phone_time_day(i):
    return calls.phone_time_report(_owned(i), i.call_targets, by_day=True)


# ---- sales ----------------------------------------------------------------------------

_SALES = f"""
SELECT inv_id, line_no, {slash_date("date")} AS date, referral_id, product_name, sources, {cash("inv_total")} AS inv_total,
  {cash("total_paid")} AS amt_paid, {week(slash_date("date"))} AS week_number,
  CASE referral_id WHEN 0 THEN 'rep_1' WHEN 1 THEN 'rep_2' WHEN 2 THEN 'rep_3' WHEN 3 THEN 'rep_4' WHEN 4 THEN 'rep_5'
    ELSE 'Other' END AS referral_partner
FROM {{sales_staged}}"""


def _sales(i):
    return sales.clean_sales(i.sales_staged, SELLERS)


@query(f"""
SELECT * REPLACE (CAST(line_no AS BIGINT) AS line_no, CAST(inv_total AS DOUBLE) AS inv_total, CAST(amt_paid AS DOUBLE) AS amt_paid) FROM ({_SALES}) AS s""")
def q_sales_clean(i):
    return _sales(i)


def _cell(name: str, where: str) -> str:
    return f"coalesce(CAST(sum(inv_total) FILTER ({where}) AS DOUBLE), 0) AS {name}"


_OFF = "lower(sources) = 'offline'"
_TOTALS = "CAST(sum(inv_total) AS DOUBLE) AS total_sales, count(inv_total) AS num_sales"


@query(f"""
SELECT week_number, {", ".join(_cell(s, f"referral_partner = '{s}' AND {_OFF}") for s in SELLER_CODES)},
  {_cell("advisors", f"referral_partner IN ('rep_1', 'rep_2', 'rep_3') AND {_OFF}")},
  {_cell("total_advised", f"referral_partner <> 'Other' AND {_OFF}")},
  {_cell("other_offline", f"referral_partner = 'Other' AND {_OFF}")},
  {_cell("online", "lower(sources) = 'online'")}, {_TOTALS}
FROM ({_SALES}) AS s GROUP BY week_number""")
def q_sales_pivot(i):
    return sales.sales_week_pivot(_sales(i), SELLER_CODES, ["rep_1", "rep_2", "rep_3"])


@query(f"""
SELECT week_number, {", ".join(_cell(s, f"referral_partner = '{s}' AND {_OFF}") for s in SELLER_CODES[:4])},
  {_cell("rep_5", f"referral_partner = 'rep_5' AND {_OFF} AND inv_total < {BIG_TICKET}")},
  {_cell("other", "referral_partner = 'Other'")},
  {_cell("big_ticket", f"product_name = 'Personal Coaching' AND inv_total >= {BIG_TICKET}")},
  {_cell("fixed_price", f"referral_partner = 'rep_4' AND inv_total IN ({', '.join(SMALL_AMOUNTS)})")}, {_TOTALS}
FROM ({_SALES}) AS s GROUP BY week_number""")
def q_sales_pivot_v2(i):
    return sales.sales_week_pivot_v2(
        _sales(i),
        SELLER_CODES,
        capped_seller="rep_5",
        big_ticket=BIG_TICKET,
        big_product="Personal Coaching",
        small_seller="rep_4",
        small_amounts=list(SMALL_AMOUNTS),
    )


@query(f"""
SELECT s.member, CAST(s.sale AS DOUBLE) AS sale, CAST(t.days AS BIGINT) AS days, CAST(t.target_sale AS BIGINT) AS target_sale
FROM (SELECT referral_partner AS member, sum(inv_total) AS sale FROM ({_SALES}) AS x
  WHERE {_OFF} AND referral_partner IN ('rep_1', 'rep_2', 'rep_3') GROUP BY 1) AS s
LEFT JOIN {{seller_schedule}} AS t ON t.name = s.member""")
def q_sales_vs_target(i):
    return sales.sales_vs_target(_sales(i), i.seller_schedule, ["rep_1", "rep_2", "rep_3"])


_SIGNUPS = f"""
SELECT CASE provider WHEN 'Rep 1' THEN 'rep_1' ELSE provider END AS provider, date, type, {week("date")} AS week_number
FROM (SELECT provider, CAST(try_strptime(date, '%m.%d.%Y') AS DATE) AS date, 'consult' AS type FROM {{signups_staged}}
  UNION ALL SELECT provider, {slash_date("record_date")}, 'sign' FROM {{signups_staged}}) AS e"""


def _signups(i):
    return sales.signup_events(i.signups_staged, {"Rep 1": "rep_1"})


def _signup_counts(keys: str) -> str:
    return (
        f"SELECT {keys}, count(*) FILTER (type = 'sign') AS number_signed, count(*) FILTER (type = 'consult') "
        f"AS number_consult FROM ({_SIGNUPS}) AS s GROUP BY {keys}"
    )


@query(_signup_counts("week_number"))
def q_signups(i):
    return sales.signups_by_week(_signups(i))


@query(_signup_counts("week_number, provider"))
def q_signups_by_provider(i):
    return sales.signups_by_week(_signups(i), by_provider=True)


# ---- geography ------------------------------------------------------------------------

_GEO = """
SELECT DISTINCT id, 'US' AS country FROM {geo_cells} WHERE geocell ILIKE 'North America / United States%'
UNION ALL SELECT DISTINCT id, 'CANADA' FROM {geo_cells} WHERE geocell ILIKE 'North America / Canada%'
UNION ALL SELECT DISTINCT id, 'NA' FROM {geo_cells} WHERE geocell = 'N / A' AND ct = 4
UNION ALL SELECT DISTINCT id, 'INT' FROM {geo_cells} WHERE id NOT IN (
  SELECT id FROM {geo_cells} WHERE geocell ILIKE 'North America / United States%'
    OR geocell ILIKE 'North America / Canada%' OR geocell = 'N / A' AND ct = 4)"""


@query(_GEO)
def q_geo_partition(i):
    return geo.geo_partition(i.geo_cells)


@query(f"""
SELECT country, count(DISTINCT id) AS ids FROM ({_GEO}) AS g GROUP BY country""")
def q_geo_counts(i):
    return geo.geo_counts(geo.geo_partition(i.geo_cells))
