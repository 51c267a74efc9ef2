"""How the library's inputs are derived from the generic tables.

Each input is one SELECT in the part of SQL that Spark and DuckDB share, so both sides of
a comparison start from the same rows.  ``{name}`` stands for a table or another input.
Every input covers its whole table, but for the older of two snapshots, which differ by
design, and event types that stand for one entity; blanks, NULLs, bad dates, repeated ids and the like
come in through CASE so that all the clean-up rules have something to do.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

AS_OF = "2001-08-02"


def _text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _slash(day: str) -> str:
    """A date as M/d/yyyy text."""
    return f"{_text(f'month({day})')} || '/' || {_text(f'day({day})')} || '/' || {_text(f'year({day})')}"


def _dotted(day: str) -> str:
    return f"{_text(f'month({day})')} || '.' || {_text(f'day({day})')} || '.' || {_text(f'year({day})')}"


def _whole(expr: str) -> str:
    return f"CAST(floor({expr}) AS BIGINT)"


def _dollars(cents: str) -> str:
    """Cents as $1,234.50 text."""
    thousands = _text(_whole(f"({cents}) / 100000"))
    rest = f"lpad({_text(_whole(f'({cents}) % 100000 / 100'))}, 3, '0')"
    tail = f"lpad({_text(f'({cents}) % 100')}, 2, '0')"
    return f"'$' || {thousands} || ',' || {rest} || '.' || {tail}"


def _clock(seconds: str) -> str:
    h = _text(_whole(f"({seconds}) / 3600"))
    m = f"lpad({_text(_whole(f'({seconds}) % 3600 / 60'))}, 2, '0')"
    s = f"lpad({_text(f'({seconds}) % 60')}, 2, '0')"
    return f"lpad({h}, 2, '0') || ':' || {m} || ':' || {s}"


def _area(key: str) -> str:
    return _text(f"200 + {key} % 700")


def _last_four(key: str) -> str:
    return f"lpad({_text(f'{key} % 10000')}, 4, '0')"


def _paren(key: str) -> str:
    return f"'(' || {_area(key)} || ') 555-' || {_last_four(key)}"


def _plain(key: str) -> str:
    return f"{_area(key)} || '555' || {_last_four(key)}"


_COUNTRY = (
    "CASE WHEN r_name = 'AMERICA' THEN CASE WHEN c_nationkey % 2 = 0 THEN 'United States' "
    "ELSE 'canada' END ELSE n_name END"
)
_CREATED = f"(DATE '{AS_OF}' - CAST((c_custkey * 37) % 2400 AS INT))"
_DOB = "(DATE '1950-01-01' + CAST((c_custkey * 53) % 18000 AS INT))"
_CUSTOMER = (
    "{customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"
)
_ODAY = "CAST(o_orderdate AS DATE)"
_EDAY = "CAST(ts AS DATE)"
_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"
_BALANCE = (
    "CASE o_orderstatus WHEN 'F' THEN CAST(0 AS DECIMAL(10,2)) "
    "WHEN 'P' THEN CAST(floor(o_totalprice / 2) AS DECIMAL(10,2)) "
    "ELSE CAST(o_totalprice AS DECIMAL(10,2)) END"
)
_STAGE = (
    "CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'Won' ELSE 'Lost' END "
    "WHEN 'P' THEN 'Working' ELSE 'New' END"
)
_TEMPLATE = (
    "CASE {0} % 6 WHEN 0 THEN 'fpc' WHEN 1 THEN 'wsm' WHEN 2 THEN 'one-off' WHEN 3 THEN 'lsi' "
    "WHEN 4 THEN 'curric' ELSE 'other' END"
)
_RESULT = (
    "CASE user_id % 8 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'No answer' "
    "WHEN 3 THEN 'not interested' WHEN 4 THEN ' ' WHEN 5 THEN 'INTERESTED - OPTY' "
    "WHEN 6 THEN 'Just Hangup' ELSE 'Left message' END"
)

INPUTS: dict[str, str] = {
    # ---- contacts ---------------------------------------------------------------------
    "contacts_staged": f"""
        SELECT c_custkey AS id,
          'First' || {_text("c_custkey % 100")} AS first_name,
          'Last' || {_text("c_custkey")} AS last_name,
          CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '  ' WHEN 3 THEN 'unknown'
            ELSE {_slash(_DOB)} END AS birthday,
          CASE c_custkey % 8 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '  '
            WHEN 3 THEN 'x' || {_plain("c_custkey")} WHEN 4 THEN {_plain("c_custkey")}
            WHEN 5 THEN '1' || {_plain("c_custkey")} WHEN 6 THEN '1 ' || {_paren("c_custkey")}
            ELSE {_paren("c_custkey")} || CASE WHEN c_custkey % 3 = 0 THEN ' ext' ELSE '' END END AS phone_1,
          CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN {_paren("c_custkey")}
            ELSE {_plain("c_custkey")} END AS phone_2,
          CASE c_custkey % 4 WHEN 0 THEN ' ' WHEN 1 THEN NULL WHEN 2 THEN '' ELSE {_COUNTRY} END AS bill_country,
          CASE c_custkey % 3 WHEN 0 THEN '' ELSE {_COUNTRY} END AS ship_country,
          CASE c_custkey % 2 WHEN 0 THEN '  ' ELSE 'USA' END AS opt_country,
          CASE c_custkey % 5 WHEN 0 THEN ' ' ELSE {_COUNTRY} END AS ip_country,
          CASE c_custkey % 4 WHEN 0 THEN '' ELSE 'City ' || {_text("c_nationkey")} END AS bill_city,
          CASE c_custkey % 3 WHEN 0 THEN NULL ELSE 'Town ' || {_text("c_nationkey")} END AS ship_city,
          CASE c_custkey % 5 WHEN 0 THEN '' ELSE 'Spot ' || {_text("c_nationkey")} END AS ip_city,
          CASE c_custkey % 4 WHEN 1 THEN '' ELSE 'BS' || {_text("c_nationkey")} END AS bill_state,
          CASE c_custkey % 3 WHEN 1 THEN NULL ELSE 'SS' || {_text("c_nationkey")} END AS ship_state,
          CASE c_custkey % 5 WHEN 1 THEN '' ELSE 'IS' || {_text("c_nationkey")} END AS ip_state,
          CASE c_custkey % 10 WHEN 0 THEN ' ' ELSE 'User' || {_text("c_custkey")} || '@Mail.example' END AS email,
          c_custkey % 5 AS owner_id,
          CASE c_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN '0' ELSE {_text("1960 + c_custkey % 40")} END AS year_birth,
          CASE c_custkey % 11 WHEN 0 THEN '' WHEN 1 THEN '13/45/2000 1:00' WHEN 2 THEN {_slash(_CREATED)}
            ELSE {_slash(_CREATED)} || ' 9:05' END AS date_created,
          CASE c_custkey % 10 WHEN 0 THEN ' ' ELSE c_mktsegment END AS lead_source,
          CASE c_custkey % 7 WHEN 0 THEN '' ELSE {_slash(_DOB)} END AS dob
        FROM {_CUSTOMER}""",
    "contacts": f"""
        SELECT c_custkey AS contact_id,
          'First' || {_text("c_custkey % 100")} AS first_name,
          'Last' || {_text("c_custkey")} AS last_name,
          CASE c_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN {_plain("c_custkey")}
            WHEN 2 THEN '1 ' || {_paren("c_custkey")} ELSE {_paren("c_custkey")} END AS phone,
          CASE c_custkey % 31 WHEN 0 THEN NULL ELSE {_COUNTRY} END AS country,
          'City ' || {_text("c_nationkey")} AS city,
          'User' || {_text("c_custkey")} || '@Mail.example' AS email,
          CASE c_custkey % 10 WHEN 0 THEN ' ' ELSE c_mktsegment END AS lead_source,
          {_CREATED} AS date_created,
          CAST((c_custkey * 37) % 2400 AS INT) AS life_time,
          {_DOB} AS dob
        FROM {_CUSTOMER}""",
    "members": f"""
        SELECT CASE c_custkey % 9 WHEN 0 THEN '' ELSE 'USER' || {_text("c_custkey * 2 - c_custkey % 3")}
            || '@mail.EXAMPLE ' END AS email, c_custkey AS member_id
        FROM {{customer}}""",
    "time_zones": f"""
        SELECT DISTINCT {_area("c_custkey")} AS city,
          CASE c_custkey % 700 % 3 WHEN 0 THEN NULL ELSE 'US' END AS cc,
          CASE c_custkey % 700 % 3 WHEN 0 THEN NULL
            ELSE 'UTC-' || {_text("c_custkey % 700 % 9")} END AS time_zone
        FROM {{customer}}
        UNION ALL
        SELECT n_name AS city, 'N' || {_text("n_nationkey")} AS cc,
          'UTC+' || {_text("n_regionkey")} AS time_zone FROM {{nation}}""",
    "no_call": """
        SELECT c_custkey AS id,
          CASE c_custkey % 13 WHEN 0 THEN 'asked us' WHEN 5 THEN 'wrong person' END AS reason
        FROM {customer}""",
    "geo_cells": f"""
        SELECT o_custkey AS id,
          CASE o_custkey % 5
            WHEN 0 THEN CASE o_orderkey % 2 WHEN 0 THEN 'North America / United States / A' ELSE 'Europe / B' END
            WHEN 1 THEN CASE o_orderkey % 3 WHEN 0 THEN 'north america / CANADA / C'
              ELSE 'North America / United States / D' END
            WHEN 2 THEN 'N / A' WHEN 3 THEN NULL ELSE 'Asia / E' END AS geocell,
          CAST(2 + o_orderkey % 4 AS INT) AS ct
        FROM {{orders}}""",
    # ---- invoices ---------------------------------------------------------------------
    "invoices_staged": f"""
        SELECT o_orderkey AS order_id, o_custkey AS contact_id,
          CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'n/a'
            ELSE {_dollars(_CENTS)} END AS inv_total,
          CASE o_orderstatus WHEN 'F' THEN '$0' WHEN 'P' THEN ' ' ELSE {_dollars(_CENTS)} END AS balance,
          CASE o_orderkey % 13 WHEN 0 THEN '13/45/2000' WHEN 1 THEN '' ELSE {_slash(_ODAY)} END AS date
        FROM {{orders}}""",
    "invoices": f"""
        SELECT o_orderkey AS order_id, o_custkey AS contact_id, {_ODAY} AS date,
          CAST(o_totalprice AS DECIMAL(10,2)) AS inv_total,
          {_BALANCE} AS balance,
          CAST(CAST(o_totalprice AS DECIMAL(10,2)) - {_BALANCE} AS DECIMAL(10,2)) AS inv_paid,
          CASE o_orderkey % 6
            WHEN 0 THEN {_text("o_orderkey % 2500")}
            WHEN 1 THEN {_text("o_orderkey % 2500")} || ',' || {_text("(o_orderkey * 7 + o_custkey) % 2500")}
            WHEN 2 THEN {_text("o_orderkey % 2500")} || ',' || {_text("o_custkey % 2500")} || ','
              || {_text("o_orderkey % 2500")}
            WHEN 3 THEN 'none,' || {_text("o_custkey % 2500")}
            WHEN 4 THEN '' END AS product_ids
        FROM {{orders}}""",
    "items": """
        SELECT p_partkey AS product_id, CAST(p_retailprice AS DECIMAL(10,2)) AS product_price FROM {part}""",
    "products": """
        SELECT p_partkey AS id,
          CASE p_partkey % 6 WHEN 0 THEN 'Dvd ' || p_name WHEN 1 THEN p_name || ' vol 2'
            WHEN 2 THEN 'Home video of ' || p_name WHEN 3 THEN 'zz ' || p_name ELSE p_name END AS product_name,
          CAST(p_retailprice AS DECIMAL(10,2)) AS price
        FROM {part}""",
    "purchases": f"""
        SELECT o_orderkey AS inv_id, o_custkey AS contact_id, 'Name ' || {_text("o_custkey")} AS name,
          CASE o_custkey % 6 WHEN 0 THEN ' ' ELSE {_paren("o_custkey")} END AS phone,
          CASE o_custkey % 5 WHEN 0 THEN 'United States' WHEN 1 THEN 'CANADA' WHEN 2 THEN ''
            ELSE 'NATION_' || {_text("o_custkey % 25")} END AS country,
          CASE o_orderkey % 7 WHEN 0 THEN 'Book of ' || o_orderpriority WHEN 1 THEN 'A dvd' WHEN 2 THEN 'Online course'
            WHEN 3 THEN 'Set vol. 3' WHEN 4 THEN 'The minimum' WHEN 5 THEN NULL ELSE 'Seminar' END AS product,
          CAST(o_orderkey % 400 AS DECIMAL(10,2)) AS invoice
        FROM {{orders}}""",
    "event_list_old": f"""
        SELECT o_orderkey AS wsid, o_orderpriority || ' ' || o_orderstatus AS description, {_ODAY} AS ws_date
        FROM {{orders}} WHERE o_orderdate <= TIMESTAMP '2001-03-01 00:00:00'""",
    "event_list_new": f"""
        SELECT o_orderkey AS wsid,
          CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN o_orderpriority
            ELSE o_orderpriority || ' ' || o_orderstatus END AS description, {_ODAY} AS ws_date
        FROM {{orders}} WHERE o_orderdate >= TIMESTAMP '1995-06-01 00:00:00'""",
    # ---- mails ------------------------------------------------------------------------
    "mail_activity": f"""
        SELECT event_id, user_id AS contact_id, event_id % 50 AS batch_id,
          {_EDAY} - CAST(event_id % 3 AS INT) AS sent,
          CASE WHEN event_type IN ('view', 'click') THEN {_EDAY} END AS opened,
          CASE WHEN event_type = 'click' THEN {_EDAY} END AS clicked,
          '/p/' || {_text("event_id % 7")} AS link
        FROM {{events}}""",
    "mail_batches": f"""
        SELECT DISTINCT event_id % 50 AS batch_id, {_TEMPLATE.format("(event_id % 50)")} AS template FROM {{events}}""",
    "broadcasts": f"""
        SELECT mail_id, DATE '2024-01-01' + CAST(mail_id * 3 % 28 AS INT) AS date,
          CASE mail_id % 4 WHEN 0 THEN 'the lsi letter' WHEN 1 THEN 'IVS offer' WHEN 2 THEN 'news'
            ELSE NULL END AS template
        FROM (SELECT DISTINCT event_id % 50 AS mail_id FROM {{events}}) AS m""",
    "sends": """
        SELECT user_id AS contact_id, event_id % 50 AS mail_id FROM {events}
        WHERE event_type <> 'purchase'""",
    "opens": f"""
        SELECT user_id AS contact_id, event_id % 50 AS mail_id, {_EDAY} AS opened FROM {{events}}
        WHERE event_type IN ('view', 'click')""",
    "mail_invoices": f"""
        SELECT event_id AS inv_id, user_id AS contact_id, {_EDAY} AS date,
          CAST(value AS DECIMAL(10,2)) AS inv_total
        FROM {{events}} WHERE event_type = 'purchase'""",
    "opt_outs": """
        SELECT user_id AS contact_id, CASE user_id % 3 WHEN 0 THEN 'spam' ELSE 'opt out' END AS type
        FROM {events} WHERE event_type = 'error'""",
    "quiet_requests": f"""
        SELECT event_id, user_id AS contact_id, {_EDAY} + CAST(event_id % 400 AS INT) AS date FROM {{events}}""",
    # ---- opportunities ----------------------------------------------------------------
    "opportunities_staged": f"""
        SELECT o_orderkey AS opp_id, o_custkey AS contact_id,
          CASE o_orderkey % 4 WHEN 0 THEN 'Sales Desk' ELSE 'rep_' || {_text("o_orderkey % 4")} END AS owner,
          {_STAGE} AS stage,
          CASE o_orderkey % 19 WHEN 0 THEN '' ELSE {_slash(f"({_ODAY} + CAST(o_orderkey % 30 AS INT))")}
            || ' 10:30' END AS next_action_date,
          {_slash(_ODAY)} || ' 8:00' AS date_create,
          {_slash(f"({_ODAY} + CAST(o_orderkey % 10 AS INT))")} AS last_update
        FROM {{orders}}""",
    "opportunities": f"""
        SELECT o_orderkey AS opp_id, o_custkey AS contact_id,
          'Deal ' || {_text("o_orderkey")} AS opp,
          'Name ' || {_text("o_custkey")} AS contact_name,
          CASE o_orderkey % 7 WHEN 0 THEN ' ' WHEN 1 THEN '(x' || {_plain("o_custkey")}
            ELSE {_paren("o_custkey")} END AS phone_number,
          'City ' || {_text("o_custkey % 25")} AS city, 'ST' AS state,
          CASE o_custkey % 5 WHEN 0 THEN 'United States' WHEN 1 THEN NULL
            ELSE 'NATION_' || {_text("o_custkey % 25")} END AS country,
          'rep_' || {_text("o_orderkey % 4")} AS owner,
          {_STAGE} AS stage,
          CASE o_orderkey % 19 WHEN 0 THEN NULL ELSE {_ODAY} + CAST(o_orderkey % 30 AS INT) END AS next_action_date,
          {_ODAY} AS date_create,
          {_ODAY} + CAST(o_orderkey % 10 AS INT) AS last_update,
          'call' AS next_action,
          CASE o_orderkey % 17 WHEN 0 THEN NULL ELSE 'note ' || {_text("o_orderkey % 5")} END AS note,
          'reason ' || {_text("o_orderkey % 3")} AS loss_reason,
          {_text("o_orderkey % 900")} AS order_revenue
        FROM {{orders}}""",
    "opportunities_before": f"""
        SELECT o_orderkey AS opp_id, 'Deal ' || {_text("o_orderkey")} AS opp,
          CASE o_orderkey % 3 WHEN 0 THEN 'New' ELSE {_STAGE} END AS stage,
          CASE o_orderkey % 19 WHEN 0 THEN NULL
            ELSE {_ODAY} + CAST(o_orderkey % 30 - o_orderkey % 4 AS INT) END AS next_action_date,
          'reason ' || {_text("o_orderkey % 2")} AS loss_reason,
          {_text("o_orderkey % 800")} AS order_revenue
        FROM {{orders}} WHERE o_orderstatus <> 'F'""",
    "bookings": f"""
        SELECT event_id, user_id AS contact_id,
          DATE '1996-01-01' + CAST(event_id * 7919 % 2000 AS INT) AS date,
          'rep_' || {_text("event_id % 4")} AS provider, 'Visitor ' || {_text("event_id")} AS name
        FROM {{events}}""",
    # ---- calls ------------------------------------------------------------------------
    "call_attempts": f"""
        SELECT {_text("event_id")} AS opty_id,
          CASE event_id % 9 WHEN 0 THEN '' ELSE 'rep_' || {_text("event_id % 5 + 1")} END AS caller_1,
          {_EDAY} AS date_1,
          CASE event_id % 2 WHEN 0 THEN ' ' ELSE 'rep_' || {_text("event_id % 3 + 1")} END AS caller_2,
          {_EDAY} + 1 AS date_2,
          CASE event_id % 4 WHEN 1 THEN 'rep_' || {_text("user_id % 4 + 1")} END AS caller_3,
          {_EDAY} + 2 AS date_3
        FROM {{events}}""",
    "follow_ups": f"""
        SELECT 'Lead ' || {_text("event_id")} AS name,
          CASE event_id % 9 WHEN 0 THEN ' ' ELSE 'rep_' || {_text("event_id % 4 + 1")} END AS caller_1,
          CASE event_id % 3 WHEN 0 THEN '' ELSE {_slash(_EDAY)} END AS date_1,
          CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE {_slash(_EDAY)} END AS date_2,
          CASE event_id % 7 WHEN 0 THEN 'sold' WHEN 1 THEN NULL ELSE ' ' END AS out_come
        FROM {{events}}""",
    "dial_results": f"""
        SELECT {_whole("event_id / 3")} AS id, CAST(event_id % 5 + 1 AS INT) AS round,
          'rep_' || {_text(f"{_whole('event_id / 3')} % 4 + 1")} AS caller,
          CASE event_id % 11 WHEN 0 THEN NULL ELSE 'First' END AS first_name,
          CASE event_id % 3 WHEN 0 THEN ' ' ELSE {_text("event_id % 60")} END AS duration,
          CASE event_id % 2 WHEN 0 THEN 'monday' ELSE 'tuesday' END AS day,
          {_RESULT} AS result
        FROM {{events}}""",
    "dispositions": """
        SELECT event_type AS kind,
          CASE event_type WHEN 'view' THEN 'NO ANSWER' WHEN 'click' THEN 'left Message'
            WHEN 'error' THEN 'Just Hangup' WHEN 'signup' THEN 'Interested - opty' ELSE 'CANCEL' END AS disposition,
          CASE event_type WHEN 'error' THEN 'No' ELSE 'yes' END AS next_round,
          'do ' || event_type AS action
        FROM (SELECT DISTINCT event_type FROM {events}) AS t""",
    "call_log": f"""
        SELECT event_id AS id, {_slash(_EDAY)} AS date,
          {_clock("event_id * 13 % 5400")} AS length,
          CASE user_id % 4 WHEN 0 THEN 'DESK 1' WHEN 1 THEN 'desk - 2' WHEN 2 THEN 'Pool' END AS from_who,
          CASE event_id % 3 WHEN 0 THEN 'DESK 3' ELSE 'Guest' END AS cid_name,
          CASE event_id % 5 WHEN 0 THEN 'CA [DESK 1]' ELSE '' END AS to_whom
        FROM {{events}}""",
    "call_targets": """
        SELECT 'rep_' || CAST(n_nationkey AS STRING) AS caller, CAST(n_nationkey * 600 AS INT) AS target_seconds
        FROM {nation}""",
    "auto_list": f"""
        SELECT event_id AS id,
          CASE event_id % 8 WHEN 0 THEN '' WHEN 1 THEN 'soon' ELSE {_slash(_EDAY)} END AS note,
          CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'x min' ELSE {_text("event_id % 47")} || ' min' END AS duration
        FROM {{events}}""",
    # ---- sales ------------------------------------------------------------------------
    "sales_staged": f"""
        SELECT l_orderkey AS inv_id, l_linenumber AS line_no, {_slash("CAST(l_shipdate AS DATE)")} AS date,
          l_suppkey % 7 AS referral_id,
          CASE l_partkey % 3 WHEN 0 THEN 'Personal Coaching' ELSE 'Kit' END AS product_name,
          CASE l_partkey % 50 WHEN 0 THEN '297' WHEN 1 THEN '997.00' WHEN 2 THEN NULL
            ELSE {_dollars("CAST(round(l_extendedprice * 100) AS BIGINT)")} END AS inv_total,
          CASE l_linestatus WHEN 'F' THEN '$10.50' ELSE '' END AS total_paid,
          CASE l_returnflag WHEN 'R' THEN 'online' ELSE 'Offline' END AS sources
        FROM {{lineitem}}""",
    "seller_schedule": """
        SELECT 'rep_' || CAST(n_nationkey AS STRING) AS name, CAST(n_nationkey % 5 AS INT) AS days,
          CAST(n_nationkey * 1000 AS INT) AS target_sale
        FROM {nation}""",
    "signups_staged": f"""
        SELECT CASE o_orderkey % 23 WHEN 0 THEN '2000-01-01' ELSE {_dotted(_ODAY)} END AS date,
          'Rep ' || {_text("o_custkey % 4")} AS provider,
          {_slash(f"({_ODAY} + CAST(o_orderkey % 9 AS INT))")} || CASE o_orderkey % 2 WHEN 0 THEN '' ELSE ' 7:15' END
            AS record_date
        FROM {{orders}}""",
}


def parts_of(sql: str) -> list[str]:
    """Names a statement refers to as ``{name}``."""
    return list(dict.fromkeys(name for _, name, _, _ in Formatter().parse(sql) if name))


class Inputs:
    """The inputs of one run as lazy DataFrames: ``Inputs(spark, folder).contacts``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        elif name in INPUTS:
            sql = INPUTS[name]
            df = self.spark.sql(sql, **{part: getattr(self, part) for part in parts_of(sql)})
        else:
            raise AttributeError(name)
        # Reading a folder's schema takes a job, so each plan is made once per run.
        setattr(self, name, df)
        return df


def with_inputs(body: str) -> str:
    """Turn ``{name}`` references of a statement into common table expressions."""
    ordered: dict[str, str] = {}

    def visit(sql: str) -> str:
        for part in parts_of(sql):
            if part in INPUTS and part not in ordered:
                ordered[part] = visit(INPUTS[part])
        return sql.format(**{part: part for part in parts_of(sql)})

    text = visit(body)
    if not ordered:
        return text
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in ordered.items())
    if text.lstrip().upper().startswith("WITH "):
        return f"WITH {ctes},\n{text.lstrip()[5:]}"
    return f"WITH {ctes}\n{text}"
