"""Dates, times and ages.

Zones: without a `zone` argument everything is read and shown in the session time zone.
"""

import datetime

from pyspark.sql import Column, functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"  # fixed value
MESSAGE_ZONE = "Asia/Kolkata"  # fixed value: zone of the wall clock sent with live messages


def _column(c):
    return F.col(c) if isinstance(c, str) else c


def parse_time(text, zone: str | None = None) -> Column:
    """Text as timestamp; null where it does not fit. `zone` is the zone the text was written in."""
    parsed = F.try_to_timestamp(_column(text), F.lit(TIME_FORMAT))
    if zone is None:
        return parsed
    local = F.convert_timezone(F.lit(zone), F.current_timezone(), parsed.cast("timestamp_ntz"))
    return local.cast("timestamp")


def event_time(date_text, time_text) -> Column:
    """Timestamp from an ISO date-time, of which only the date counts, and a time of day."""
    date = F.split(_column(date_text), "T")[0]
    return parse_time(F.concat_ws(" ", date, _column(time_text)))


def as_date(value) -> Column:
    """The day ages are counted at: today, or a fixed date given as text, date or column."""
    if value is None:
        return F.current_date()
    if isinstance(value, (str, datetime.date)):
        return F.lit(str(value)).cast("date")
    return value


def age_years(birth, as_of=None, zone: str | None = None) -> Column:
    """Whole years of 365 days (not calendar years) since the day of birth."""
    birth = _column(birth)
    if zone is not None:
        birth = F.convert_timezone(None, F.lit(zone), birth)
    return (F.datediff(as_date(as_of), F.to_date(birth)) / 365).cast("int")


def wall_clock(instant, zone: str = MESSAGE_ZONE) -> Column:
    """An instant as wall-clock text of a zone."""
    return F.date_format(F.convert_timezone(None, F.lit(zone), _column(instant)), TIME_FORMAT)


def epoch_millis(instant) -> Column:
    return F.unix_millis(_column(instant).cast("timestamp"))
