"""Call attempts, dial rounds and the phone log."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.config import (
    FINAL_DISPOSITIONS,
    INTERESTED,
)
from clientele.functions.dates import (
    clock_text,
    day_name,
    hours_minutes_text,
    parse_date,
    seconds_of,
    week_label,
)
from clientele.functions.text import (
    is_blank,
    mapped,
    not_blank,
    percent_text,
    ratio,
    same_text,
)
from clientele.operators.joins import lookup
from clientele.operators.reshape import union_all, unpivot_groups

NO_COUNT = "no_count"


# ---- attempts -------------------------------------------------------------------------


def call_attempts_long(
    attempts: DataFrame,
    targets: dict[str, int],
    shifts: dict[str, tuple[str, ...]],
) -> DataFrame:
    """One row per attempt with weekday, the caller's target and whether it was a shift day."""
    groups = [
        {"caller": f"caller_{n}", "date": f"date_{n}", "attempt": F.lit(label)}
        for n, label in ((1, "call_once"), (2, "call_twice"), (3, "call_three_times"))
    ]
    rows = unpivot_groups(attempts, ["opty_id"], groups).filter(not_blank("caller"))
    on_shift = F.lit(False)
    for caller, days in shifts.items():
        on_shift = on_shift | (same_text("caller", caller) & F.col("day_name").isin(*days))
    return (
        rows.withColumn("day_name", day_name("date"))
        .withColumn("target", mapped("caller", targets, default=0))
        .withColumn("work", F.when(on_shift, "Y").otherwise("N"))
    )


def calls_per_day(attempts: DataFrame) -> DataFrame:
    """Attempts per caller and day next to the caller's target."""
    return attempts.groupBy("caller", "date", "day_name", "target").agg(
        F.count("opty_id").alias("number_called")
    )


def call_day_pivot(attempts: DataFrame, days: list[date]) -> DataFrame:
    """One column per day with ``calls/target --- percent%``; no percent without a target.

    ``other_days`` counts the attempts on days not asked for, or without a date.
    """
    per_day = attempts.groupBy("caller", "target").agg(
        *(F.count_if(F.coalesce(F.col("date") == F.lit(d), F.lit(False))).alias(f"_{d:%Y%m%d}") for d in days),
        F.count_if(~F.coalesce(F.col("date").isin(*days), F.lit(False))).alias("other_days"),
    )

    def cell(d: date) -> Column:
        n = F.col(f"_{d:%Y%m%d}")
        share = percent_text(ratio(n, F.col("target")))
        shown = F.concat(n.cast("string"), F.lit("/"), F.col("target").cast("string"), F.lit(" --- "), share)
        return shown.alias(f"day_{d:%Y_%m_%d}")

    return per_day.select("caller", *(cell(d) for d in days), "other_days")


def follow_up_coverage(follow_ups: DataFrame) -> DataFrame:
    """Leads per first caller that were fully, partly or not followed up."""
    first, second, outcome = not_blank("date_1"), not_blank("date_2"), not_blank("out_come")
    full = (first & second) | outcome
    none = ~first & ~second & ~outcome
    return (
        follow_ups.filter(not_blank("caller_1"))
        .groupBy("caller_1")
        .agg(
            F.count_if(full).alias("full_address"),
            F.count_if(~full & ~none).alias("partly_address"),
            F.count_if(none).alias("non_address"),
        )
    )


# ---- dial results ---------------------------------------------------------------------


def disposition_follow_up(results: DataFrame, dispositions: DataFrame) -> DataFrame:
    """Results that call for another round, with the action to take."""
    joined = lookup(results, dispositions, "result", "disposition", how="inner")
    return joined.filter(same_text("next_round", "Yes"))


def dial_stats(*days: DataFrame) -> DataFrame:
    """Per caller and day: contacts to call, called, interested and picked up."""
    called, picked = not_blank("result"), not_blank("duration")
    interested = F.coalesce(same_text("result", *INTERESTED), F.lit(False))
    stats = (
        union_all(*days)
        .groupBy("caller", "day")
        .agg(
            F.count("first_name").alias("to_call"),
            F.count_if(called).alias("calls"),
            F.count_if(interested).alias("opportunities"),
            F.count_if(picked).alias("pick_ups"),
        )
    )
    rate = ratio(F.col("pick_ups"), F.col("calls"))
    return stats.withColumn("not_called", F.col("to_call") - F.col("calls")).withColumn(
        "pick_up_pct", percent_text(rate)
    )


def rounds_long(rounds: dict[int, DataFrame]) -> DataFrame:
    """The result tables of all rounds as one, numbered by round."""
    return union_all(*(df.withColumn("round", F.lit(n)) for n, df in rounds.items()))


def dial_rounds_wide(
    results: DataFrame,
    schedule: dict[str, tuple[tuple[int, ...], int]],
    final: tuple[str, ...] = FINAL_DISPOSITIONS,
) -> DataFrame:
    """A contact's results over the rounds its caller dials, blank where nothing happened.

    ``schedule`` has each caller's rounds and how many touched ones make a contact complete.

    A contact belongs to the caller who had it in the first round of that caller's
    schedule.  Results that end the rounds are shown as ``no_count``.
    """
    width = max(len(rounds) for rounds, _ in schedule.values())
    numbers = sorted({n for rounds, _ in schedule.values() for n in rounds})

    def at_round(n: int) -> Column:
        return F.max(F.when(F.col("round") == n, F.struct("result", "caller")))

    # Of several rows for one round the last by result, then caller, counts as a whole.
    rounds_of = results.groupBy("id").agg(*(at_round(n).alias(f"_{n}") for n in numbers))
    wide = rounds_of.select(
        "id",
        *(F.col(f"_{n}.result").alias(f"r{n}") for n in numbers),
        *(F.col(f"_{n}.caller").alias(f"c{n}") for n in numbers),
    )

    def shown(rounds: tuple[int, ...], place: int) -> Column:
        if place >= len(rounds):
            return F.lit("")
        text = F.col(f"r{rounds[place]}")
        return (
            F.when(same_text(text, *final), NO_COUNT).when(is_blank(text), "").otherwise(text)
        )

    rows = [
        F.when(
            F.col(f"c{rounds[0]}") == caller,
            F.struct(
                F.lit(caller).alias("caller"),
                *(shown(rounds, i).alias(f"result{i + 1}") for i in range(width)),
            ),
        )
        for caller, (rounds, _) in schedule.items()
    ]
    found = F.filter(F.array(*rows), lambda r: r.isNotNull())
    return wide.select("id", F.inline(found))


def _touched(width: int) -> Column:
    return sum((not_blank(f"result{i + 1}").cast("int") for i in range(width)), F.lit(0))


def _ended(width: int) -> Column:
    ended = F.lit(False)
    for i in range(width):
        ended = ended | (F.col(f"result{i + 1}") == NO_COUNT)
    return ended


def dial_coverage(
    wide: DataFrame, schedule: dict[str, tuple[tuple[int, ...], int]]
) -> DataFrame:
    """Contacts per caller that were dialled fully, partly or not at all.

    Full: the rounds ended, or as many rounds as the caller's rule asks were touched.
    """
    width = max(len(rounds) for rounds, _ in schedule.values())
    needed = mapped("caller", {c: n for c, (_, n) in schedule.items()})
    touched = _touched(width)
    full = _ended(width) | (touched >= needed)
    none = touched == 0
    return wide.groupBy("caller").agg(
        F.countDistinct("id").alias("total_request"),
        F.count_if(full).alias("full_address"),
        F.count_if(~full & ~none).alias("partly_address"),
        F.count_if(none).alias("non_address"),
    )


def never_reached_list(wide: DataFrame) -> DataFrame:
    """Contacts without a result in any of their rounds."""
    width = sum(c.startswith("result") for c in wide.columns)
    return wide.filter(_touched(width) == 0).select("id", "caller")


def clean_auto_list(staged: DataFrame) -> DataFrame:
    """Date out of the note, minutes out of the number the duration starts with."""
    return staged.withColumn("note", parse_date("note")).withColumn(
        "duration", F.regexp_extract("duration", r"^\s*([0-9]+)", 1).try_cast("int")
    )


# ---- phone log ------------------------------------------------------------------------


def call_log_owner(calls: DataFrame, lines: dict[str, str]) -> DataFrame:
    """Calls of known people: the first person listed whose name stands on either side of the call.

    ``lines`` maps the names a phone system shows to a person, in order of precedence; calls
    of nobody listed drop out.
    """
    shown = ("from_who", "cid_name", "to_whom")

    def is_on(person: str) -> Column:
        names = [name for name, p in lines.items() if p == person]
        on = F.lit(False)
        for column in shown:
            on = on | F.coalesce(same_text(F.col(column), *names), F.lit(False))
        return F.when(on, F.lit(person))

    owner = F.coalesce(*(is_on(person) for person in dict.fromkeys(lines.values())))
    seconds = seconds_of("length")
    return (
        calls.withColumn("owner", owner)
        .filter(F.col("owner").isNotNull())
        .withColumn("date", parse_date("date"))
        .withColumn("length_sec", seconds)
        .withColumn("length_hour", hours_minutes_text(seconds))
    )


def phone_time_report(calls: DataFrame, targets: DataFrame, by_day: bool = False) -> DataFrame:
    """Talk time per person and week (or day) against the person's target.

    The mean is taken over the days worked; the variance is its distance from the target.
    """
    keys = ["owner", "week_number", *(["date"] if by_day else [])]
    days = F.lit(1).cast("long") if by_day else F.countDistinct("date")
    sums = (
        calls.withColumn("week_number", week_label("date"))
        .groupBy(*keys)
        .agg(
            F.sum("length_sec").alias("_sec"),
            F.count("id").alias("number_of_calls"),
            (days if not by_day else F.max(days)).alias("number_day_worked"),
        )
    )
    joined = lookup(sums, targets.select("caller", "target_seconds"), "owner", "caller")
    mean = ratio(F.col("_sec"), F.col("number_day_worked"))
    return joined.select(
        *keys,
        clock_text("_sec").alias("total_call_time"),
        "number_of_calls",
        "number_day_worked",
        clock_text(F.floor(mean)).alias("ave_time_day"),
        clock_text("target_seconds").alias("bench_mark"),
        percent_text(ratio(mean, F.col("target_seconds")) - 1).alias("variance"),
    )
