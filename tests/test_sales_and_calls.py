"""Opportunities, dial rounds, phone log, sales and the world map."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clientele.plans import calls, geo, opportunities, sales

D = dt.date


def test_consult_match_equals_brute_force(spark):
    rng = random.Random(5)
    bookings = [(rng.randint(1, 4), D(2015, 1, rng.randint(1, 28)), f"r{rng.randint(0, 2)}", f"n{i}") for i in range(40)]
    opps = [
        (rng.randint(1, 4), i, f"r{rng.randint(0, 2)}", "New", D(2015, 1, rng.randint(1, 28)), D(2015, 1, rng.randint(1, 28)))
        for i in range(40)
    ]
    got = opportunities.consult_to_opportunity(
        spark.createDataFrame(bookings, "contact_id long, date date, provider string, name string"),
        spark.createDataFrame(
            opps, "contact_id long, opp_id long, owner string, stage string, date_create date, last_update date"
        ),
    )
    expected = {}
    for c, booked, provider, name in bookings:
        for oc, oid, owner, _, created, touched in opps:
            if c != oc:
                continue
            if touched > booked and owner == provider:
                key = (touched, oid, -booked.toordinal())
                expected["May be updated", c] = max(key, expected.get(("May be updated", c), (D.min, 0, 0)))
            if created > booked:
                key = (created, oid, -booked.toordinal())
                expected["Created", c] = max(key, expected.get(("Created", c), (D.min, 0, 0)))
    seen = {
        (r.type, r.contact_id): (
            r.last_update if r.type == "May be updated" else r.date_create, r.opp_id, -r.booked.toordinal()
        )
        for r in got.collect()
    }
    assert seen == expected


DIAL_SCHEDULE = {"rep_1": ((2, 3), 2), "rep_2": ((1, 2, 3, 4, 5), 3), "rep_3": ((1, 3, 5), 3), "rep_4": ((2, 4), 2)}


def dial(spark, rows):
    return spark.createDataFrame(rows, "id long, round int, caller string, result string")


def test_dial_rounds_follow_the_callers_schedule(spark, rows):
    df = dial(
        spark,
        [
            (1, 2, "rep_4", "No answer"), (1, 4, "rep_9", "wrong number"), (1, 1, "rep_9", "x"),
            (2, 2, "rep_4", None), (2, 4, "rep_4", " "),
            (3, 4, "rep_4", "late"),
            (4, 2, "rep_4", "a"), (4, 2, "rep_4", " "),
            # The larger result is another caller's: result and caller are those of one row.
            (5, 2, "rep_4", "a"), (5, 2, "rep_1", "b"),
        ],
    )
    wide = calls.dial_rounds_wide(df, DIAL_SCHEDULE)
    assert rows(wide, "id", "caller", "result1", "result2", "result3") == [
        (1, "rep_4", "No answer", "no_count", ""),
        (2, "rep_4", "", "", ""),
        (4, "rep_4", "a", "", ""),
        (5, "rep_1", "b", "", ""),
    ]
    assert rows(calls.never_reached_list(wide)) == [(2, "rep_4")]
    assert rows(calls.dial_coverage(wide, DIAL_SCHEDULE)) == [("rep_1", 1, 0, 1, 0), ("rep_4", 3, 1, 1, 1)]


def test_coverage_adds_up(spark):
    rng = random.Random(2)
    results = ["", None, "no answer", "CANCEL", "left message"]
    data = [
        (i, n, f"rep_{1 + i % 4}", rng.choice(results)) for i in range(200) for n in range(1, 6) if rng.random() < 0.8
    ]
    cover = calls.dial_coverage(calls.dial_rounds_wide(dial(spark, data), DIAL_SCHEDULE), DIAL_SCHEDULE).collect()
    assert len(cover) == len(DIAL_SCHEDULE)
    assert all(r.full_address + r.partly_address + r.non_address == r.total_request for r in cover)


def test_rounds_long_numbers_the_tables(spark, rows):
    a = spark.createDataFrame([(1,)], "id int")
    assert rows(calls.rounds_long({1: a, 3: a})) == [(1, 1), (1, 3)]


def test_phone_time_report(spark):
    log = spark.createDataFrame(
        [(1, "1/5/2015", "01:00:00", "DESK 1", "", ""), (2, "1/6/2015", "00:30:00", "guest", "desk 1", ""),
         (3, "1/6/2015", "25:00:00", "pool", "x", "desk 1"), (4, "1/6/2015", "01:00:00", "pool", "x", "y")],
        "id long, date string, length string, from_who string, cid_name string, to_whom string",
    )
    targets = spark.createDataFrame([("rep_1", 3600)], "caller string, target_seconds int")
    owned = calls.call_log_owner(log, {"DESK 1": "rep_1"})
    row = calls.phone_time_report(owned, targets).first()
    assert (row.week_number, row.total_call_time, row.number_of_calls, row.number_day_worked) == (
        "W15.02", "26:30:00", 3, 2
    )
    assert (row.ave_time_day, row.bench_mark, row.variance) == ("13:15:00", "01:00:00", "1225.00%")


def test_owner_is_the_first_person_listed(spark):
    log = spark.createDataFrame(
        [(1, "1/5/2015", "00:01:00", "desk 2", "", "CA [DESK 1]"), (2, "1/5/2015", "00:01:00", "desk 2", None, "desk 2")],
        "id long, date string, length string, from_who string, cid_name string, to_whom string",
    )
    lines = {"DESK 1": "rep_1", "DESK 2": "rep_2", "CA [DESK 1]": "rep_1"}
    assert {r.id: r.owner for r in calls.call_log_owner(log, lines).collect()} == {1: "rep_1", 2: "rep_2"}


def test_day_pivot_counts_the_other_days(spark):
    df = spark.createDataFrame(
        [("rep_1", D(2015, 6, 1), 4, "1"), ("rep_1", D(2015, 6, 2), 4, "2"), ("rep_1", None, 4, "3")],
        "caller string, date date, target int, opty_id string",
    )
    row = calls.call_day_pivot(df, [D(2015, 6, 1)]).first()
    assert (row.day_2015_06_01, row.other_days) == ("1/4 --- 25.00%", 2)


def test_day_pivot_without_target_has_no_text(spark):
    df = spark.createDataFrame(
        [("rep_1", D(2015, 6, 1), 4, "1"), ("rep_9", D(2015, 6, 1), 0, "2")],
        "caller string, date date, target int, opty_id string",
    )
    got = {r.caller: r.day_2015_06_01 for r in calls.call_day_pivot(df, [D(2015, 6, 1)]).collect()}
    assert got == {"rep_1": "1/4 --- 25.00%", "rep_9": None}


def test_follow_up_classes(spark):
    df = spark.createDataFrame(
        [("r", "1/1", "1/2", None), ("r", None, " ", "sold"), ("r", "1/1", "", " "), ("r", " ", None, ""), (" ", "1", "1", "")],
        "caller_1 string, date_1 string, date_2 string, out_come string",
    )
    assert [tuple(r) for r in calls.follow_up_coverage(df).collect()] == [("r", 2, 1, 1)]


def test_sales_pivot_totals(spark):
    staged = spark.createDataFrame(
        [(1, "6/1/2015", 7, "A", "$1,000.00", "0", "Offline"), (2, "6/2/2015", 8, "A", "50", "0", "offline"),
         (3, "6/2/2015", 7, "A", "20", None, "Online"), (4, "6/2/2015", None, "A", None, None, "Offline")],
        "inv_id long, date string, referral_id long, product_name string, inv_total string, total_paid string, "
        "sources string",
    )
    typed = sales.clean_sales(staged, {"7": "rep_1"})
    row = sales.sales_week_pivot(typed, ["rep_1"], ["rep_1"]).first()
    assert (row.rep_1, row.other_offline, row.online, row.total_sales, row.num_sales) == (1000, 50, 20, 1070, 4)
    assert row.advisors == row.total_advised == 1000


def test_geo_classes(spark, rows):
    df = spark.createDataFrame(
        [(1, "North America / United States / x", 1), (1, "north america / canada", 1), (2, "N / A", 4),
         (3, "N / A", 3), (4, None, 4), (4, "Asia", 4)],
        "id long, geocell string, ct int",
    )
    part = geo.geo_partition(df)
    assert rows(part) == [(1, "CANADA"), (1, "US"), (2, "NA"), (3, "INT"), (4, "INT")]


def opp(spark, rows):
    cols = (
        "opp_id long, contact_id long, opp string, contact_name string, phone_number string, city string, state string, "
        "country string, owner string, stage string, next_action_date date, date_create date, last_update date, "
        "next_action string, note string, loss_reason string, order_revenue string"
    )
    return spark.createDataFrame(rows, cols)


def test_week_report_classes(spark):
    def row(n, stage, due, created, touched):
        return (n, n, f"o{n}", "c", "(415) 1", "x", "y", "US", "r", stage, due, created, touched, "call", "note", "l", "1")

    now = opp(
        spark,
        [
            row(1, "New", D(2015, 8, 1), D(2015, 7, 14), D(2015, 7, 14)),
            row(2, "Won", D(2015, 7, 15), D(2015, 1, 1), D(2015, 7, 15)),
            row(3, "Working", D(2015, 7, 25), D(2015, 1, 1), D(2015, 7, 15)),
            row(4, "Working", D(2015, 7, 19), D(2015, 1, 1), D(2015, 7, 12)),
            row(5, "Working", D(2015, 8, 25), D(2015, 1, 1), None),
        ],
    )
    before = opp(spark, [row(3, "New", D(2015, 7, 15), None, None), row(5, "New", D(2015, 8, 25), None, None)])
    report = opportunities.opportunity_week_report(
        now, before, (D(2015, 7, 13), D(2015, 7, 19)), (D(2015, 7, 20), D(2015, 7, 26)), D(2015, 7, 20), "u/", "W15."
    )
    got = sorted((r.type, r.opp_id, r.week_number, r.working_stage) for r in report.collect())
    assert got == [
        ("Addressed", 2, "W15.29", "Won"),
        ("Addressed", 3, "W15.29", "New--->Working"),
        ("New", 1, "W15.29", "New"),
        ("Not addressed", 4, "W15.29", "Working"),
        ("Will address", 3, "W15.30", "Working"),
    ]
    live = opportunities.live_opportunity_calls(report, "c/").collect()
    assert sorted((r.opp_id, r.time_city) for r in live) == [(3, "415"), (4, "415")]
    moved = opportunities.moved_opportunities(now, before).collect()
    assert [(r.opp_id, r.days_moved) for r in moved] == [(3, 10)]


def test_signup_events_use_their_own_dates(spark):
    df = spark.createDataFrame([("7.14.2015", "J", "7/21/2015 9:00"), ("bad", "J", "")], "date string, provider string, record_date string")
    events = sales.signup_events(df, {"j": "rep_1"})
    got = sorted((str(r.week_number), r.number_signed, r.number_consult) for r in sales.signups_by_week(events).collect())
    assert got == [("None", 1, 1), ("W15.29", 0, 1), ("W15.30", 1, 0)]
    assert {r.provider for r in events.collect()} == {"rep_1"}


@pytest.mark.parametrize("result,kept", [("No Answer ", True), ("cancel", False), (None, False)])
def test_disposition(spark, result, kept):
    table = spark.createDataFrame([("NO ANSWER", "Yes", "again"), ("CANCEL", "No", "-")], "disposition string, next_round string, action string")
    df = spark.createDataFrame([(1, result)], "id int, result string")
    assert (calls.disposition_follow_up(df, table).count() == 1) is kept


def test_auto_list(spark):
    df = spark.createDataFrame([("7/1/2015", "5 min"), ("7/1/2015", "12 min"), ("x", "m")], "note string, duration string")
    got = [tuple(r) for r in calls.clean_auto_list(df).select("note", F.col("duration")).collect()]
    assert got == [(D(2015, 7, 1), 5), (D(2015, 7, 1), 12), (None, None)]
