"""Time stamps as text in UTC, second precision (``YYYY-MM-DDTHH:MM:SSZ``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import col, py_strip

# The form of stamps at rest.
Z_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
STAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
#: Extended ISO-8601 forms that are accepted: date, date and time, fraction, zone. A plain cast would
#: also take lone times, single digits and region names.
ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
WEEKDAY = r"^\s*(?i:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s*"


def utc_z(ts: str | Column) -> Column:
    """A timestamp as text; the session's time zone is UTC."""
    return F.date_format(col(ts), Z_FORMAT)


def iso_to_utc_z(c: str | Column) -> Column:
    """ISO-8601 text to a UTC stamp, fraction cut off, no zone meaning UTC; NULL if it is none."""
    t = col(c)
    whole = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"[.,]\d+", ""), r"([+-]\d{2})(\d{2})$", "$1:$2"), r"([T ]\d{2})(Z|[+-]|$)", "$1:00$2"), r"([+-]\d{2})$", "$1:00")
    fixed = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t).otherwise(whole)
    return F.when(t.rlike(ISO), F.date_format(F.try_to_timestamp(fixed), Z_FORMAT))


def strict_utc_z(c: str | Column) -> Column:
    """The stamp as a timestamp if it is exactly of the form at rest, else NULL."""
    t = py_strip(c)
    return F.when(t.rlike(STAMP), F.try_to_timestamp(t, F.lit(Z_FORMAT)))


def feed_date(c: str | Column) -> Column:
    """Dates of feeds: RFC 822 (weekday optional) or ISO; NULL if neither."""
    t = F.regexp_replace(F.trim(col(c)), WEEKDAY, "")
    named = F.regexp_replace(F.regexp_replace(t, r"(?i)\b(UT|UTC|GMT|Z)$", "+0000"), r"\b([+-]\d{2}):(\d{2})$", "$1$2")
    tries = [F.try_to_timestamp(named, F.lit(p)) for p in ("d MMM yyyy HH:mm:ss xx", "d MMM yyyy HH:mm xx", "d MMM yyyy HH:mm:ss")]
    return F.coalesce(*tries, F.try_to_timestamp(iso_to_utc_z(t)))


def plus_hours(ts: Column, hours: int) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(hours))
