"""Time expressions (F1-F5) as Column builders; built-in functions only.

All times are ``TIMESTAMP_NTZ`` holding the UTC wall clock, so the session
time zone never changes a result. "now" is always an argument (a literal or
a column), so jobs and tests are repeatable.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from sigfleet.schemas import API_TIME_FORMAT, HISTORY_DEFAULT_HOURS, RANGE_KEYWORDS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(value) -> Column:
    """A ``TIMESTAMP_NTZ`` literal from a datetime or an ISO string."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value.rstrip("Z"))
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        value = value.replace(tzinfo=None)
    # From ISO text: a Python datetime literal would pass through the
    # process's local zone and the session zone on its way to NTZ.
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def format_time(text, url_encode: bool = False) -> Column:
    """service time text ``yyyy-MM-ddTHH:mm:ssZ``.

    One trailing ``Z`` is dropped, the rest is parsed as ISO text and cut to
    whole seconds. An explicit offset is dropped without conversion. Text
    that does not parse comes back as given, minus the ``Z``.
    """
    t = F.regexp_replace(_col(text), r"Z\z", "")
    parsed = _iso(t)
    out = F.coalesce(F.date_format(parsed, API_TIME_FORMAT), t)
    if url_encode:
        out = F.replace(out, F.lit(":"), F.lit("%3A"))
    return out


# ISO date (extended or basic), then optionally a separator of any kind, a
# time to the hour, minute, second or fraction, and an offset.
_ISO = (
    r"\A(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:(?s:.)(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?"
    r"(?:Z|[+-]\d{2}(?::?\d{2}(?::?\d{2}(?:\.\d+)?)?)?)?)?\z"
)


def _iso(text: Column) -> Column:
    """ISO text as NTZ to whole seconds, its offset dropped; else null."""
    parts = F.regexp_replace(text, _ISO, "$1-$3-$4 $5:$6:$7")
    filled = F.regexp_replace(F.regexp_replace(parts, " (?=:)", " 00"), r":(?=:|$)", ":00")
    return F.when(text.rlike(_ISO), filled.try_cast("timestamp_ntz"))


# White space that Python's str.strip removes.
_EDGE = r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$"


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, _EDGE, "")


_MINUTE = r"\A(\d{4})-(\d{1,2})-(\d{1,2})\s+(\d{1,2}):(\d{1,2})\z"
_DAY = r"\A(\d{4})-(\d{1,2})-(\d{1,2})\z"


def _typed(text: Column, form: str, out: str) -> Column:
    padded = F.regexp_replace(F.regexp_replace(text, form, out), r"\b0(\d\d)\b", "$1")
    return F.when(text.rlike(form), padded.try_cast("timestamp_ntz"))


def _typed_minute(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm`` with one or two digits per part; else null."""
    return _typed(text, _MINUTE, "$1-0$2-0$3 0$4:0$5:00")


def _typed_day(text: Column) -> Column:
    """``yyyy-MM-dd``, month and day of one or two digits; else null."""
    return _typed(text, _DAY, "$1-0$2-0$3")


def _days_back(keyword: Column) -> Column:
    k = F.lower(keyword)
    expr = None
    for days in sorted(set(RANGE_KEYWORDS.values())):
        words = [w for w, d in RANGE_KEYWORDS.items() if d == days]
        expr = F.when(k.isin(words), days) if expr is None else expr.when(k.isin(words), days)
    return expr


def range_start(text, now, calendar: bool = False) -> Column:
    """F2 + F3: start of a query range from what a user typed.

    Keyword (blank, today, yesterday, week, in two languages) -> now minus
    1, 2 or 7 days; 10 characters -> that date at midnight; otherwise
    ``yyyy-MM-dd HH:mm``; anything else -> null (rejected).
    ``calendar=True`` makes "yesterday" start at yesterday's midnight
    (the documented meaning) instead of now minus 48 hours.
    """
    t = _strip(_col(text))
    days = _days_back(t)
    back = ntz(now) - F.make_dt_interval(days)
    if calendar:
        midnight = F.to_date(ntz(now) - F.make_dt_interval(F.lit(1))).cast("timestamp_ntz")
        back = F.when(days == 2, midnight).otherwise(back)
    return (
        F.when(days.isNotNull(), back)
        .when(F.length(t) == 10, _typed_day(t))
        .otherwise(_typed_minute(t))
    )


def range_end(text, now) -> Column:
    """end of a query range. Blank -> now; a date -> that day 23:59:59;
    otherwise ``yyyy-MM-dd HH:mm``. Keywords are not accepted (null)."""
    t = _strip(_col(text))
    end_of_day = F.make_dt_interval(F.lit(0), F.lit(23), F.lit(59), F.lit(59))
    return (
        F.when(t == "", ntz(now))
        .when(F.length(t) == 10, _typed_day(t) + end_of_day)
        .otherwise(_typed_minute(t))
    )


def lookback_hours(text) -> Column:
    """hours typed as text; blank or not a whole number -> the default."""
    t = _strip(_col(text))
    return F.coalesce(
        F.when(t.rlike(r"\A[+-]?\d+\z"), t.try_cast("int")), F.lit(HISTORY_DEFAULT_HOURS)
    )


def lookback_number(hours) -> int:
    """F5 for a job argument: a number, or text by the same rule."""
    try:
        return int(hours)
    except (TypeError, ValueError):
        return HISTORY_DEFAULT_HOURS


def lookback_start(hours, now) -> Column:
    """``now`` minus ``hours`` hours."""
    h = hours if isinstance(hours, Column) else F.lit(int(hours))
    return ntz(now) - F.make_dt_interval(F.lit(0), h)
