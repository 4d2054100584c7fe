"""Dates and times in text. Results do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import values
from . import text


def _month_day(c: Column) -> Column:
    # "MMM" rejects full month names, hence two patterns.
    return F.coalesce(F.try_to_date(c, "MMM d, yyyy"), F.try_to_date(c, "MMMM d, yyyy"))


def day_after_on(c: Column) -> Column:
    """DATE of ``on Jun 9, 2026`` or ``June 9, 2026``; null when it cannot be read."""
    return _month_day(F.regexp_replace(text.strip(c), r"(?i)^on\s+", ""))


def day_text(c: Column) -> Column:
    """``09-06-2026`` for a readable date, else the cleaned text."""
    cleaned = F.regexp_replace(text.strip(c), r"(?i)^on\s+", "")
    return F.coalesce(F.date_format(_month_day(cleaned), "dd-MM-yyyy"), cleaned)


_DATED = r"on\s+(\w+ \d{1,2},\s*\d{4})"


def review_date_part(c: Column) -> Column:
    """The date text inside ``NAME on Oct 9, 2025``; null when there is none."""
    return F.nullif(F.regexp_extract(c, _DATED, 1), F.lit(""))


def review_day(part: Column) -> Column:
    """DATE of a found date text; null when it cannot be read."""
    return _month_day(F.regexp_replace(part, r",\s*", ", "))


def review_day_text(part: Column, day: Column) -> Column:
    """ISO day of a found date text; the text itself when unreadable."""
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), part)


def deadline_text(c: Column) -> Column:
    """``d/m/yyyy`` inside the text, else the text itself."""
    return F.coalesce(F.nullif(F.regexp_extract(c, r"(\d{1,2}/\d{1,2}/\d{4})", 1), F.lit("")), c)


def deadline_day(c: Column) -> Column:
    return F.try_to_date(c, "d/M/yyyy")


def age_in_months(created: Column, as_of: Column) -> Column:
    """Months of 30.44 days between two dates, one decimal."""
    return F.round(F.datediff(as_of, created) / F.lit(values.DAYS_PER_MONTH), 1)


_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def time_of_object_id(c: Column) -> Column:
    """UTC time held in the first eight hex digits of an object id."""
    seconds = F.conv(F.substring(c, 1, 8), 16, 10).try_cast("bigint")
    return F.expr(_EPOCH) + F.make_dt_interval(secs=seconds)


def time_of_iso(c: Column) -> Column:
    """UTC time of an ISO-8601 text ending in Z."""
    return F.regexp_replace(c, r"Z$", "").try_cast("timestamp_ntz")


def board_time(utc: Column, hours: int = values.BOARD_UTC_HOURS) -> Column:
    """Board-local time: a fixed offset from UTC."""
    return utc + F.make_dt_interval(hours=F.lit(hours))


def created_at(action_time: Column, object_id: Column) -> Column:
    """Board-local creation time: the recorded action when known, else the object id."""
    return board_time(F.coalesce(time_of_iso(action_time), time_of_object_id(object_id)))


def day_code(c: Column) -> Column:
    return F.date_format(c, "ddMMyy")
