"""Text rules shared by every clean-up step.

Exported text marks "nothing here" in three ways: NULL, an empty string or spaces.
All three count as blank, and names compare without regard to case.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(10,2)"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """True for NULL, empty and all-space text; never NULL."""
    return F.trim(F.coalesce(as_col(c).cast("string"), F.lit(""))) == ""


def not_blank(c: Column | str) -> Column:
    return ~is_blank(c)


def blank_to_null(c: Column | str) -> Column:
    return F.when(not_blank(c), as_col(c))


def first_nonblank(*cols: Column | str) -> Column:
    """The first column holding text, NULL when all are blank."""
    return F.coalesce(*(blank_to_null(c) for c in cols))


def match_key(c: Column | str) -> Column:
    """Key for comparing names and addresses: case and outer spaces do not count."""
    return F.lower(F.trim(as_col(c)))


def same_text(c: Column | str, *values: str) -> Column:
    """Case-insensitive ``IN`` over literal values; NULL input gives NULL."""
    return match_key(c).isin([v.strip().lower() for v in values])


def like_any(c: Column | str, patterns: Iterable[str]) -> Column:
    """One case-insensitive test for a whole OR-list of LIKE patterns."""
    wild = {"%": ".*", "_": "."}
    parts = ("".join(wild.get(ch) or re.escape(ch) for ch in p) for p in patterns)
    return as_col(c).rlike("(?is)^(?:" + "|".join(parts) + ")$")


def money(c: Column | str) -> Column:
    """``$1,234.50`` to a decimal; blank is 0, text that is no number is NULL."""
    digits = F.trim(F.translate(as_col(c), "$,", ""))
    return F.when(is_blank(c), F.lit(0).cast(MONEY)).otherwise(digits.try_cast(MONEY))


def whole_number(c: Column | str) -> Column:
    """Text to an integer; blank or unreadable text is NULL."""
    return F.trim(as_col(c)).try_cast("int")


def first_word(c: Column | str) -> Column:
    """Text before the first space, or all of it when there is none."""
    return F.split(as_col(c), " ", 2)[0]


def ratio(part: Column, whole: Column) -> Column:
    """Double division that yields NULL on a zero divisor."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent_text(share: Column) -> Column:
    """``0.125`` as ``12.50%``; NULL stays NULL."""
    shown = F.round(share * 100, 2).cast("decimal(14,2)").cast("string")
    return F.concat(shown, F.lit("%"))


def change_text(old: Column, new: Column, arrow: str) -> Column:
    """``old<arrow>new``; NULL when either side is NULL."""
    return F.concat(old.cast("string"), F.lit(arrow), new.cast("string"))


def record_link(base_url: str, record_id: Column | str) -> Column:
    """Address of a record in the caller's own system; NULL without an id."""
    return F.concat(F.lit(base_url), as_col(record_id).cast("string"))


def mapped(c: Column | str, table: dict[str, object], default: object = None) -> Column:
    """Look a text up in a small literal table (case-insensitive), inside the projection."""
    pairs = [F.lit(x) for key, value in table.items() for x in (key.strip().lower(), value)]
    hit = F.element_at(F.create_map(*pairs), match_key(c))
    return hit if default is None else F.coalesce(hit, F.lit(default))
