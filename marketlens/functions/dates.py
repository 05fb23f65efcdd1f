"""Time rules: feed text to instants, instants to seller-local calendar days.

Two zones are in play and they are not the same. Feed text without an offset is
at a fixed UTC+3. Reports are labelled by the calendar of the named zone, which
had summer time until 2011 and UTC+4 until October 2014.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
REPORT_ZONE = "Europe/Moscow"
FEED_OFFSET = "+03:00"
# Feed texts before this cannot be shifted three hours back within year 1; the
# source keeps them at their face value in UTC.
FIRST_SHIFTABLE = "0001-01-01T03:00:00"

_DATE_LENGTH = 10


def feed_instant(text: Column, blank_is_null: bool = True) -> Column:
    """ISO text to an instant, independent of the session time zone.

    Text without an offset gets one appended before the cast. With
    ``blank_is_null=False`` an empty text fails the batch instead.
    """
    if blank_is_null:
        text = F.nullif(text, F.lit(""))
    # Second test: the separator may be a blank, which sorts before the T.
    too_early = (text < FIRST_SHIFTABLE) & (F.translate(text, " ", "T") < FIRST_SHIFTABLE)
    offset = F.when(too_early, F.lit("Z")).otherwise(F.lit(FEED_OFFSET))
    has_offset = F.substring(text, _DATE_LENGTH + 2, 40).rlike("[Z+-]")
    missing = (
        F.when(F.length(text) == _DATE_LENGTH, F.concat(F.lit("T00:00:00"), offset))
        .when(has_offset, F.lit(""))
        .otherwise(offset)
    )
    return F.concat(text, missing).cast("timestamp")


def local_date(instant: Column) -> Column:
    """Calendar day in the report zone (needs a UTC session, see ``configure``)."""
    return F.to_date(F.from_utc_timestamp(instant, REPORT_ZONE))


def week_start(day: Column) -> Column:
    """Monday of the week of ``day``."""
    return F.to_date(F.date_trunc("week", day))


def feed_midnight(instant: Column) -> Column:
    """Start of the UTC+3 day that contains ``instant``, as an instant."""
    shifted = F.date_trunc("day", instant + F.expr("interval 3 hours"))
    return shifted - F.expr("interval 3 hours")


def feed_day_end(instant: Column) -> Column:
    """Last second of the UTC+3 day that contains ``instant``."""
    return feed_midnight(instant) + F.expr("interval '23:59:59' hour to second")


def request_text(instant: Column) -> Column:
    """How a cursor is written into a request: UTC, no offset."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")
