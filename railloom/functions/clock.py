"""Dates, times of day and durations from text (ids C7, C11-C14, C25).

A pattern check on the raw text decides which form it has, and only then is it stripped and its parts cut out by their
separators, which is much cheaper than a capture group per part.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railloom.functions.coerce import matches, strip

DAY = r"\d{4}-\d{2}-\d{2}"
COMPACT_DAY = r"\d{8}"
MOMENT = DAY + r"[ tT].*"
ZONE = r".*(?:[zZ]|[+-]\d{2}:?\d{2})"
CLOCK = r"(?:[01]\d|2[0-3]):[0-5]\d(?::[0-5]\d)?"
LOOSE_CLOCK = r"(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?"
HOUR_MINUTE = r"(?:[01]?\d|2[0-3]):[0-5]?\d"
SPAN_HM = r"\d+:[0-5]\d"
DAYS = r"\d+ days?,? *"
SPAN_HMS = SPAN_HM + r":[0-5]\d(?:\.\d+)?"


def _compact_to_iso(text: Column) -> Column:
    return F.concat_ws("-", *[F.substring(text, at, n) for at, n in ((1, 4), (5, 2), (7, 2))])


def date_from_text(c: Column) -> Column:
    """ISO (or yyyymmdd) text to a date, read on the UTC clock whatever the session time zone is.

    Only text that starts with a day is tried: a bare '08:30' would otherwise be read as today.
    """

    text = strip(c)
    zoned = F.when(matches(c, ZONE), text).otherwise(F.concat(text, F.lit("Z")))
    utc_day = F.floor(F.unix_seconds(zoned.try_cast("timestamp")) / 86400)
    return (
        F.when(matches(c, DAY), text.try_cast("date"))
        .when(matches(c, COMPACT_DAY), _compact_to_iso(text).try_cast("date"))
        .when(matches(c, MOMENT), F.date_from_unix_date(utc_day.cast("int")))
    )


def timestamp_from_text(c: Column) -> Column:
    """ISO (or yyyymmdd) text to a wall-clock timestamp; NULL when it is not one."""

    text = strip(c)
    return F.when(matches(c, f"{DAY}|{MOMENT}"), text.try_cast("timestamp_ntz")).when(
        matches(c, COMPACT_DAY), _compact_to_iso(text).try_cast("timestamp_ntz")
    )


def _with_seconds(clock: Column) -> Column:
    """'HH:MM' and 'HH:MM:SS' to the latter."""
    return F.substring(F.concat(clock, F.lit(":00")), 1, 8)


def time_of_day(c: Column) -> Column:
    """C11: 'HH:MM' or 'HH:MM:SS' to canonical 'HH:mm:ss'; hour 24 and up, or bad parts, give NULL."""
    return F.when(matches(c, CLOCK), _with_seconds(strip(c)))


def loose_time_of_day(c: Column) -> Column:
    """As C11, and a one-digit hour or a fraction of a second is accepted."""

    text = strip(c)
    whole = F.substring_index(text, ".", 1)
    padded = F.when(text.substr(2, 1) == ":", F.concat(F.lit("0"), whole)).otherwise(whole)
    return F.when(matches(c, LOOSE_CLOCK), _with_seconds(padded))


def hour_minute(c: Column) -> Column:
    """C12 strict: hour and minute only; seconds make it NULL."""
    text = strip(c)
    two = [F.lpad(F.substring_index(text, ":", end), 2, "0") for end in (1, -1)]
    return F.when(matches(c, HOUR_MINUTE), F.concat_ws(":", *two, F.lit("00")))


def duration_interval(c: Column) -> Column:
    """C13: 'HHH:MM[:SS]' or 'N days HH:MM[:SS]' to an interval; bare numbers and other text give NULL."""

    def clock(before: str, text: Column) -> Column:
        cut = F.regexp_replace(text, r"(\.\d{6})\d+$", "$1")  # an interval has microseconds
        whole = F.when(matches(c, before + SPAN_HM), F.concat(text, F.lit(":00"))).when(matches(c, before + SPAN_HMS), cut)
        return whole.try_cast("interval hour to second").cast("interval day to second")

    days = F.substring_index(strip(c), " ", 1).try_cast("int")
    rest = F.regexp_replace(strip(c), f"^{DAYS}", "")
    return F.when(c.contains("day"), F.make_dt_interval(days) + clock(DAYS, rest)).otherwise(clock("", strip(c)))


def duration_minutes(c: Column) -> Column:
    """C14: the same texts in minutes."""
    epoch = F.timestamp_micros(F.lit(0))
    return F.unix_micros(epoch + duration_interval(c)) / 60_000_000


def interval_text(c: Column) -> Column:
    """An interval as '[D day[s], ]H:MM:SS'."""
    days = F.extract(F.lit("DAY"), c)
    hours = F.extract(F.lit("HOUR"), c)
    minutes = F.extract(F.lit("MINUTE"), c)
    seconds = F.extract(F.lit("SECOND"), c).cast("int")

    def two(x: Column) -> Column:
        return F.lpad(x.cast("string"), 2, "0")

    clock = F.concat_ws(":", hours.cast("string"), two(minutes), two(seconds))
    return F.when(
        c.isNotNull(),
        F.when(days == 0, clock)
        .when(days == 1, F.concat(F.lit("1 day, "), clock))
        .otherwise(F.concat(days.cast("string"), F.lit(" days, "), clock)),
    )
