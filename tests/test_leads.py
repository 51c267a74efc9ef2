"""Lead lists: segments, ranks, routes, exclusions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clientele.plans import contacts, leads

D = dt.date
BASE = "https://crm.example/"


@pytest.mark.parametrize(
    "phone,clicked,group,segment",
    [
        (" ", "x", "Domestic", "seg1"),
        (None, None, "International", "seg1"),
        ("1", None, "International", "seg2"),
        ("1", "x", "International", "seg3"),
        ("1", None, "Domestic", "seg4"),
        ("1", "x", "Domestic", "seg5"),
        ("1", "x", None, "unclassified"),
    ],
)
def test_response_segment(spark, phone, clicked, group, segment):
    df = spark.createDataFrame([(phone, clicked, group)], "p string, c string, g string")
    assert df.select(leads.response_segment("p", "c", "g")).first()[0] == segment


def lead_rows(spark, rows):
    cols = "contact_id long, segment string, sent date, what_done string, clicked date, opened date"
    full = [(c, s, sent, w, None, None) for c, s, sent, w in rows]
    return spark.createDataFrame(full, cols)


def test_best_lead_is_one_row_per_type_and_contact(spark):
    df = lead_rows(
        spark,
        [
            (1, "lsi", D(2015, 7, 20), "a"),
            (1, "FPC", D(2015, 7, 21), "b"),
            (1, "fpc", D(2015, 7, 22), "c"),
            (1, "fpc", D(2015, 7, 1), "d"),
            (1, "curric", D(2015, 7, 1), "e"),
            (2, "purchase", None, "f"),
            (2, "dob", None, "g"),
            (3, "mystery", D(2015, 7, 22), "h"),
            (4, "wsm", None, "i"),
        ],
    )
    typed = leads.split_new_old(leads.add_lead_rank(df), D(2015, 7, 20))
    best = leads.best_lead_per_contact(typed).collect()
    assert sorted((r.type, r.contact_id, r.what_done) for r in best) == [
        ("New", 1, "c"),
        ("New", 2, "f"),
        ("Old", 1, "d"),
    ]


def test_routes_are_disjoint_and_complete(spark):
    stages = ["Won", "lost", None, "Working", "New", "Frozen"]
    rows = [(n, s, g) for n, (s, g) in enumerate((s, g) for s in stages for g in ("Domestic", "International"))]
    df = spark.createDataFrame(rows, "contact_id long, stage string, seg_country string")
    routed = {(r.stage, r.seg_country): r.route for r in leads.route_leads(df, BASE).collect()}
    assert routed == {
        **{(s, "Domestic"): "auto" for s in ("Won", "lost", None)},
        **{(s, "International"): "manual" for s in ("Won", "lost", None)},
        **{(s, g): "awakened" for s in ("Working", "New") for g in ("Domestic", "International")},
    }


def test_route_list_columns(spark):
    df = spark.createDataFrame([(1, "Won", "Domestic")], "contact_id long, stage string, seg_country string")
    for c in leads.ROUTE_COLUMNS:
        if c not in (*df.columns, "link"):
            df = df.withColumn(c, F.lit(None).cast("string"))
    auto = leads.route_list(leads.route_leads(df, BASE), "auto")
    assert tuple(auto.columns) == leads.ROUTE_COLUMNS
    assert auto.first().link == BASE + "1"


NO_ONE = "id long, reason string"


def lists_of(spark, rows):
    """Lists from (contact_id, segment, actions, sent) rows."""
    cols = "contact_id long, segment string, actions string, sent date, what_done string, phone string, clicked date, opened date"
    return leads.contact_lists(spark.createDataFrame([(*r, None, "p", None, None) for r in rows], cols), D(2015, 7, 20))


def test_text_list_drops_contacts_whose_deals_are_all_later(spark):
    lists = lists_of(spark, [(n, "fpc", "seg4", None) for n in (1, 2, 3, 4)])
    opps = spark.createDataFrame(
        [(1, D(2015, 8, 9)), (2, D(2015, 8, 9)), (2, D(2015, 7, 1)), (3, D(2015, 8, 9)), (3, None)],
        "contact_id long, next_action_date date",
    )
    who = spark.createDataFrame([(n, f"N{n}") for n in (1, 2, 3, 4)], "contact_id long, first_name string")
    got = leads.text_message_list(lists, spark.createDataFrame([], NO_ONE), opps, who, D(2015, 8, 2))
    assert sorted((r.contact_id, r.first_name) for r in got.collect()) == [(2, "N2"), (3, "N3"), (4, "N4")]


def test_lists_choose_from_one_frame(spark):
    rows = [
        (1, "lsi", "seg4", D(2015, 7, 21)), (1, "fpc", "seg5", D(2015, 7, 1)), (1, "wsm", "seg5", D(2015, 7, 22)),
        (2, "curric", "seg4", None), (2, "purchase", "seg5", None),
        (3, "fpc", "seg1", D(2015, 7, 21)), (4, "mystery", "seg4", D(2015, 7, 1)), (5, "dob", "seg5", None),
        (6, "fpc", "seg3", D(2015, 7, 22)), (7, "fpc", "seg5", None),
    ]
    lists = lists_of(spark, rows)
    no_call = spark.createDataFrame([(2, "asked"), (1, None)], NO_ONE)
    none = spark.createDataFrame([], "contact_id long, next_action_date date")
    who = spark.createDataFrame([], "contact_id long, first_name string")
    called = {(r.type, r.contact_id, r.segment) for r in leads.leads_to_call(lists).collect()}
    assert called == {("New", 1, "wsm"), ("Old", 1, "fpc"), ("New", 2, "purchase"), ("New", 5, "dob"), ("New", 6, "fpc")}
    texts = leads.text_message_list(lists, no_call, none, who, D(2015, 8, 2)).collect()
    assert {(r.contact_id, r.segment, r["rank"]) for r in texts} == {(1, "fpc", 5), (2, "curric", 1)}
    mails = leads.mail_blast_list(lists, no_call, seed=1).collect()
    assert {(r.contact_id, r.segment, r.actions) for r in mails} == {
        (1, "fpc", "seg5"), (2, "curric", "seg4"), (3, "fpc", "seg1"), (4, "mystery", "seg4"), (5, "dob", "seg5"), (6, "fpc", "seg3"),
    }


def test_exclusive_contacts(spark):
    df = spark.createDataFrame(
        [(1, "inner"), (1, "Inner"), (2, "inner"), (2, "fpc"), (3, "fpc")], "contact_id long, segment string"
    )
    got = leads.segment_exclusive_contacts(df, "inner").collect()
    assert [(r.contact_id, r.responses) for r in got] == [(1, 2)]


def test_blast_number_is_repeatable_and_in_range(spark):
    lists = lists_of(spark, [(n, "fpc", "seg1", None) for n in range(500)])
    no_call = spark.createDataFrame([], NO_ONE)
    runs = [{r.contact_id: r.num for r in leads.mail_blast_list(lists, no_call, seed=5).collect()} for _ in range(2)]
    assert runs[0] == runs[1] and all(10000 <= n <= 99999 for n in runs[0].values())


def test_drawn_numbers_do_not_depend_on_partitions(spark):
    lists = lists_of(spark, [(n, "fpc", "seg1", None) for n in range(500)])
    no_call = spark.createDataFrame([], NO_ONE)
    draw = lambda x, seed: {r.contact_id: r.num for r in leads.mail_blast_list(x, no_call, seed, random=True).collect()}
    first = draw(lists, 9)
    assert draw(lists.repartition(7, "contact_id"), 9) == first == draw(lists.coalesce(1), 9)
    assert draw(lists, 10) != first and all(10_000 <= n <= 99_998 for n in first.values())
    # Without a seed each list has numbers of its own, and keeps them.
    fresh = leads.mail_blast_list(lists, no_call, random=True)
    once = {r.contact_id: r.num for r in fresh.collect()}
    assert {r.contact_id: r.num for r in fresh.repartition(5).collect()} == once != draw(lists, None)


def test_birthday_list_spans_new_year(spark):
    who = spark.createDataFrame(
        [(1, "A", "B", "(415) 1", "Canada", D(1980, 12, 30)), (2, "A", "B", "1", "x", D(1980, 1, 2)),
         (3, "A", "B", " ", "x", D(1980, 1, 2)), (4, "A", "B", "1", "x", D(1980, 6, 2))],
        "contact_id long, first_name string, last_name string, phone string, country string, dob date",
    )
    opps = spark.createDataFrame([(1, 9, "rep_1", "Won")], "contact_id long, opp_id long, owner string, stage string")
    got = {r.contact_id: r for r in contacts.birthday_list(who, opps, (12, 28), (1, 3), BASE).collect()}
    assert set(got) == {1, 2}
    assert (got[1].actions, got[1].opty_link, got[1].time_city) == ("seg5", BASE + "9", "415")
    assert (got[2].actions, got[2].opty_link, got[2].time_city) == ("seg3", None, "x")


def test_quiet_period_ends_at_month_end(spark):
    df = spark.createDataFrame([(D(2015, 8, 31),)], "date date")
    assert leads.do_not_send_until(df).first().dont_sent_until == D(2016, 2, 29)
