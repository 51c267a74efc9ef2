"""From an export as read, all text, to typed columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from clientele.functions.dates import DOT_DATE, SLASH_DATE, parse_timestamp_date
from clientele.functions.text import money


def typed(
    staged: DataFrame, dates: Iterable[str] = (), amounts: Iterable[str] = (), date_format: str = SLASH_DATE
) -> DataFrame:
    """Date texts to dates and money texts to decimals; columns the export lacks are skipped.

    A time behind a date is dropped; an unreadable date is NULL, blank money is 0.
    """
    have = set(staged.columns)
    return staged.withColumns(
        {
            **{c: parse_timestamp_date(c, date_format) for c in dates if c in have},
            **{c: money(c) for c in amounts if c in have},
        }
    )


def clean_purchases(staged: DataFrame) -> DataFrame:
    """Weekly purchases with their amounts as numbers."""
    return typed(staged, amounts=["invoice"])


def clean_mail_activity(staged: DataFrame) -> DataFrame:
    """Mail activity with the days a mail was sent, opened and clicked."""
    return typed(staged, dates=["sent", "opened", "clicked"])


def clean_broadcasts(staged: DataFrame) -> DataFrame:
    """Broadcasts with the day they went out."""
    return typed(staged, dates=["date"])


def clean_consult_bookings(staged: DataFrame) -> DataFrame:
    """Consult bookings; their days are written with dots."""
    return typed(staged, dates=["date"], date_format=DOT_DATE)
