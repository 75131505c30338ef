"""Strict date formats, event times, late-arrival days and partition dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# SQL predicates over {v}: YYYY-MM-DD naming a real day (years from 1000 keep four
# digits), and YYYY-MM-DD HH:MM:SS naming a real second of a real day.
CALENDAR_DATE = ("coalesce(octet_length({v}) = 10 and {v} rlike '^[1-9][0-9]{{3}}-[0-9]{{2}}-[0-9]{{2}}' "
                 "and try_cast({v} as date) is not null, false)")
CALENDAR_DATE_TIME = (
    "({v} rlike '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$' "
    "and " + CALENDAR_DATE.replace("{v}", "substr({v}, 1, 10)") + ")")

FORMAT_CHECKS = {"pipeline-date": CALENDAR_DATE, "pipeline-date-time": CALENDAR_DATE_TIME}


def is_calendar_date(column: str) -> Column:
    return F.expr(CALENDAR_DATE.format(v=column))


def is_calendar_date_time(column: str) -> Column:
    return F.expr(CALENDAR_DATE_TIME.format(v=column))


def event_time(text: Column) -> Column:
    """Zone-free time of a ``Y-m-d H:M:S`` text; NULL for any other shape."""
    shaped = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$")
    return F.when(shaped, text.try_cast("timestamp_ntz"))


def whole_days_between(earlier: Column, later: Column) -> Column:
    """Completed 24-hour periods from ``earlier`` to ``later``."""
    return F.extract(F.lit("DAY"), later - earlier).cast("int")


def days_crossed(start: Column, end: Column) -> Column:
    """Midnights crossed from ``start`` to ``end``; NULL when either is missing."""
    return F.datediff(end, start)


def iso_text(text: Column) -> Column:
    """Trimmed, without the Z that marks UTC."""
    return F.replace(F.trim(text), F.lit("Z"), F.lit(""))


def partition_time(plain: Column) -> Column:
    """Time used for year/month layout, from an ``iso_text``.

    Accepts ISO dates and date-times ('T' or blank, fractions, zone suffix kept
    as written), the compact ``YYYYMMDD`` day, and otherwise the
    first 19 characters read as ``Y-m-d H:M:S``.
    """
    iso = F.when(
        plain.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?([+-]\d{2}:\d{2})?)?$"),
        plain.try_cast("timestamp_ntz"))
    compact = F.when(
        plain.rlike(r"^\d{8}$"), F.try_to_date(plain, "yyyyMMdd").cast("timestamp_ntz"))
    return F.coalesce(iso, compact, event_time(F.substring(plain, 1, 19)))


def year_text(time: Column) -> Column:
    return F.year(time).cast("string")


def month_text(time: Column) -> Column:
    return F.lpad(F.month(time).cast("string"), 2, "0")
