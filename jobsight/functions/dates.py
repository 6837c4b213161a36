"""Date and time text rules (C13-C15) as native expressions.

Timestamps travel as text in the record layer (``yyyy-MM-dd HH:mm:ss``) and as
``timestamp_ntz`` in the warehouse layer.  Parsing goes through
``try_to_timestamp`` so ANSI mode never raises; wall-clock arithmetic is done on
``timestamp_ntz`` so the session zone never shifts a value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, is_falsy

TEXT_FMT = "yyyy-MM-dd HH:mm:ss"
# ISO-8601 as Python's fromisoformat reads it: date, optional time (hour,
# minute, second, fraction).  An offset is left out, and only counts after a time
# of day ('2026-04-28' keeps its '-28').
_ISO = (r"^(\d{4}-\d{2}-\d{2}(?:[T ]\d{2}(?::\d{2}(?::\d{2}(?:\.\d{1,6})?)?)?(?=Z?$|[+-]\d{2}(?::?\d{2})?$)|(?=$)))")


def _ntz(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def parse_iso(c) -> Column:
    """ISO-8601 text to ``timestamp_ntz``; an offset is dropped, not converted."""
    c = _col(c)
    return _ntz(F.try_to_timestamp(F.replace(F.regexp_extract(c, _ISO, 1), F.lit("T"), F.lit(" "))))


def format_ts(ts) -> Column:
    return F.date_format(_col(ts), TEXT_FMT)


def format_date(c) -> Column:
    """ISO text to 'yyyy-MM-dd HH:mm:ss'; falsy 'N/A'; unparsable unchanged."""
    c = _col(c)
    return F.when(is_falsy(c), F.lit("N/A")).otherwise(F.coalesce(format_ts(parse_iso(c)), c))


def iso_seconds_or_input(c, falsy: str = "") -> Column:
    """Cut at '.', strict 'Y-m-dTH:M:S'; falsy gives ``falsy``; else unchanged."""
    c = _col(c)
    head = F.substring_index(c, ".", 1)
    ts = F.try_to_timestamp(head, F.lit("yyyy-M-d'T'H:m:s"))
    return F.when(is_falsy(c), F.lit(falsy)).otherwise(F.coalesce(format_ts(ts), c))


def iso_or_now(c, now) -> Column:
    """ISO-8601 (offset dropped) to text; falsy or unparsable gives ``now``."""
    c = _col(c)
    return F.when(is_falsy(c), _col(now)).otherwise(F.coalesce(format_ts(parse_iso(c)), _col(now)))


def long_date_or_now(c, now) -> Column:
    """C13d: 'April 28, 2026' to text; falsy or unparsable gives ``now``."""
    c = _col(c)
    ts = F.try_to_timestamp(c, F.lit("MMMM d, yyyy"))
    return F.when(is_falsy(c), _col(now)).otherwise(F.coalesce(format_ts(ts), _col(now)))


def millis_or_now(c, now) -> Column:
    """C13e: epoch milliseconds to wall-clock text in the session zone; null gives ``now``."""
    c = _col(c)
    ms = c.cast("string").try_cast("long")
    return F.coalesce(format_ts(F.timestamp_millis(ms)), _col(now))


def parse_text_ts(c) -> Column:
    """'%Y-%m-%d %H:%M:%S' (one-digit parts allowed) to ``timestamp_ntz``."""
    return _ntz(F.try_to_timestamp(_col(c), F.lit("yyyy-M-d H:m:s")))


def days_later(ts, days: int = 30) -> Column:
    """C14 of a parsed timestamp: ``days`` days later as text; null gives 'N/A'."""
    return F.coalesce(format_ts(_col(ts) + F.make_dt_interval(F.lit(days))), F.lit("N/A"))


def apply_end_date(c, days: int = 30) -> Column:
    """C14: last_seen + ``days`` days as text; unparsable gives 'N/A'."""
    return days_later(parse_text_ts(c), days)


# Job-age buckets by whole days between first and last sighting.
JOB_AGE_BUCKETS = [(1, "new"), (7, "hot"), (15, "recent"), (21, "aging"), (30, "old")]


def days_between(a, b) -> Column:
    """Whole days of |b - a|, null where one is null."""
    return F.floor(F.abs(F.timestamp_diff("SECOND", _col(a), _col(b))) / F.lit(86400))


def age_bucket(days) -> Column:
    """C15 of a number of days; null gives 'unknown'.  Pass a column: it is read once per bucket."""
    days = _col(days)
    out = F.when(days.isNull(), F.lit("unknown"))
    for limit, label in JOB_AGE_BUCKETS:
        out = out.when(days <= limit, F.lit(label))
    return out.otherwise(F.lit("expired"))


def job_age(first_seen, last_seen) -> Column:
    """Bucket of whole days of |last - first|; missing/unparsable 'unknown'."""
    return age_bucket(days_between(parse_text_ts(first_seen), parse_text_ts(last_seen)))
