"""Phone checks and dial areas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clientele.functions.text import as_col, is_blank, not_blank

# Which character must be a digit for a phone to be usable.
FIRST, SECOND, LAST = "first", "second", "last"


def _probe(phone: Column, where: str) -> Column:
    if where == FIRST:
        return F.left(phone, F.lit(1))
    if where == SECOND:
        return F.right(F.left(phone, F.lit(2)), F.lit(1))
    if where == LAST:
        return F.right(phone, F.lit(1))
    raise ValueError(f"unknown phone check {where!r}")


def is_bad_phone(phone: Column | str, where: str = FIRST) -> Column:
    """True for a phone that holds text but fails the digit check; blanks are not bad."""
    phone = F.trim(as_col(phone))
    return not_blank(phone) & ~_probe(phone, where).rlike("^[0-9]$")


def usable_phone(phone: Column | str, where: str = FIRST) -> Column:
    """The phone, or '' when it is blank or fails the check."""
    phone = F.trim(as_col(phone))
    return F.when(is_blank(phone) | is_bad_phone(phone, where), F.lit("")).otherwise(phone)


def area_code(phone: Column | str, layout: str = "any") -> Column:
    """Three-digit area code of a North American number.

    ``any`` works on the digits alone: a leading 1 is dropped and three are kept.  The
    other layouts read fixed positions: ``plain`` is ``4155550100`` / ``14155550100``,
    ``paren`` is ``(415) 555-0100`` / ``1 (415) 555-0100`` and ``before_paren`` takes
    the three characters in front of ``)``.
    """
    phone = F.trim(as_col(phone))
    leading_one = F.left(phone, F.lit(1)) == "1"
    if layout == "any":
        return F.left(F.regexp_replace(F.regexp_replace(phone, "[^0-9]", ""), "^1", ""), F.lit(3))
    if layout == "plain":
        last_ten = F.right(phone, F.lit(10))
        return F.when(leading_one, F.substring(phone, 2, 3)).otherwise(F.left(last_ten, F.lit(3)))
    if layout == "paren":
        return F.when(leading_one, F.substring(phone, 4, 3)).otherwise(F.substring(phone, 2, 3))
    if layout == "before_paren":
        head = F.right(F.substring_index(phone, ")", 1), F.lit(3))
        return F.when(F.contains(phone, F.lit(")")), head).otherwise(F.lit(""))
    raise ValueError(f"unknown phone layout {layout!r}")
