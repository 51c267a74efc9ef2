"""Revenue per mail against brute force over all invoice-mail pairs."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clientele.plans import attribution

DAY0 = dt.date(2020, 1, 1)


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(11)
    contacts = [1] * 6 + [2, 3, 4, None]
    invoices = [
        (i, rng.choice(contacts), rng.choice([None, *range(25)]), rng.randint(100, 9999)) for i in range(120)
    ]
    sends = [(rng.choice(contacts), rng.randint(0, 9)) for _ in range(60)]
    broadcasts = [(m, rng.choice([None, 0, 4, 9, 15]), rng.choice(["IVS now", "news", None])) for m in range(9)]
    opens = [(rng.choice(contacts), rng.randint(0, 6), rng.choice([None, *range(20)])) for _ in range(50)]
    return invoices, sends, broadcasts, opens


@pytest.fixture(scope="module")
def frames(spark, data):
    invoices, sends, broadcasts, opens = data
    inv = spark.createDataFrame(
        [(i, c, day(d), cents) for i, c, d, cents in invoices],
        "inv_id long, contact_id long, date date, cents long",
    ).withColumn("inv_total", (F.col("cents") / 100).cast("decimal(10,2)"))
    return (
        inv.drop("cents"),
        spark.createDataFrame(sends, "contact_id long, mail_id long"),
        spark.createDataFrame(
            [(m, day(d), t) for m, d, t in broadcasts], "mail_id long, date date, template string"
        ),
        spark.createDataFrame(
            [(c, m, day(d)) for c, m, d in opens], "contact_id long, mail_id long, opened date"
        ),
    )


def brute(invoices, windows):
    """windows: contact -> {mail: (first day, last day)}"""
    out = defaultdict(lambda: [0, 0.0, 0.0])
    for _, c, d, cents in invoices:
        mails = [
            m for m, (lo, hi) in windows.get(c, {}).items() if c is not None and d is not None and lo <= d <= hi
        ]
        if not mails:
            out[None][0] += 1
        for m in mails:
            out[m][0] += 1
            out[m][1] += 1 / len(mails)
            out[m][2] += cents / 100 / len(mails)
    return out


def check(result, expected):
    got = {r.mail_id: r for r in result.collect()}
    assert set(got) == set(expected)
    for m, (n, effect, earned) in expected.items():
        assert got[m].num_sale == n
        if m is None:
            assert got[m].effect_sales is None and got[m].earned is None
        else:
            assert got[m].effect_sales == pytest.approx(effect)
            assert got[m].earned == pytest.approx(earned)


def sent_windows(data, keep=lambda t: True):
    _, sends, broadcasts, _ = data
    last = {m: d + 3 for m, d, t in broadcasts if d is not None and keep(t)}
    out = defaultdict(dict)
    for c, m in sends:
        if m in last and c is not None:
            out[c][m] = (-999, last[m])
    return out


def test_by_sent(data, frames):
    inv, sends, broadcasts, _ = frames
    check(attribution.revenue_by_sent(inv, sends, broadcasts), brute(data[0], sent_windows(data)))


def test_by_sent_among_creative_mails_only(data, frames):
    inv, sends, broadcasts, _ = frames
    creative = attribution.creative_mails(broadcasts)
    expected = brute(data[0], sent_windows(data, keep=lambda t: t is not None and "IVS" in t))
    expected.pop(None, None)
    check(attribution.revenue_by_sent(inv, sends, creative, keep_unattributed=False), expected)


def test_by_open(data, frames):
    inv, _, _, opens = frames
    first = {}
    for c, m, d in data[3]:
        if m != 0 and d is not None:
            first[c, m] = min(d, first.get((c, m), 999))
    windows = defaultdict(dict)
    for (c, m), d in first.items():
        windows[c][m] = (d, d + 3)
    check(attribution.revenue_by_open(inv, opens), brute(data[0], windows))


def test_both_window_ends_count_and_shares_add_up(spark):
    opens = spark.createDataFrame([(1, 5, day(0)), (1, 6, day(3))], "contact_id long, mail_id long, opened date")
    inv = spark.createDataFrame(
        [(1, 1, day(0), 10.0), (2, 1, day(3), 20.0), (3, 1, day(7), 30.0)],
        "inv_id long, contact_id long, date date, inv_total double",
    ).withColumn("inv_total", F.col("inv_total").cast("decimal(10,2)"))
    got = {r.mail_id: (r.num_sale, r.earned) for r in attribution.revenue_by_open(inv, opens).collect()}
    assert got == {5: (2, 20.0), 6: (1, 10.0), None: (1, None)}


def test_no_invoice_gives_no_row(frames):
    inv, sends, broadcasts, opens = frames
    none = inv.filter("inv_id < 0")
    assert attribution.revenue_by_sent(none, sends, broadcasts).count() == 0
    assert attribution.revenue_by_open(none, opens).count() == 0


def test_no_mail_leaves_everything_unattributed(frames):
    inv, sends, broadcasts, opens = frames
    for result in (
        attribution.revenue_by_sent(inv, sends.filter("mail_id < 0"), broadcasts),
        attribution.revenue_by_open(inv, opens.filter("mail_id < 0")),
    ):
        assert [tuple(r) for r in result.collect()] == [(None, 120, None, None)]
