"""Date sentinels, search windows and epoch seconds."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "no date given".
NO_DATE = ("None", "")

# The two date notations users write.
US_DAY = re.compile(r"(\d{1,2})-(\d{1,2})-(\d{4})")
ISO_DAY = re.compile(r"(\d{4})-(\d{1,2})-(\d{1,2})")

DateLike = Column | str | dt.date | None


def is_valid_date(c: Column) -> Column:
    return c.isNotNull() & ~c.isin(*NO_DATE)


def _given(value: DateLike) -> bool:
    return value is not None and not (isinstance(value, str) and value in NO_DATE)


def temporal_range(start: DateLike, end: DateLike) -> tuple[DateLike, DateLike] | None:
    """The pair of bounds, with ``None`` for an open one, or ``None`` if both are open."""
    if not (_given(start) or _given(end)):
        return None
    return (start if _given(start) else None, end if _given(end) else None)


def parse_day(value: Column | str | dt.date) -> Column:
    """A day written as ``M-d-yyyy`` or ``yyyy-MM-dd``; anything else is an error.

    Python values become literals, so that Catalyst can push the comparison into the scan.
    """
    if isinstance(value, dt.datetime):
        return F.lit(value.date())
    if isinstance(value, dt.date):
        return F.lit(value)
    if isinstance(value, str):
        if m := US_DAY.fullmatch(value):
            return F.lit(dt.date(int(m[3]), int(m[1]), int(m[2])))
        if m := ISO_DAY.fullmatch(value):
            return F.lit(dt.date(int(m[1]), int(m[2]), int(m[3])))
        raise ValueError(f"not a date: {value!r}")
    parsed = F.coalesce(F.try_to_timestamp(value, F.lit("M-d-yyyy")),
                        F.try_to_timestamp(value, F.lit("yyyy-M-d"))).cast("date")
    return F.when(is_valid_date(value), F.coalesce(
        parsed, F.raise_error(F.concat(F.lit("not a date: "), value)).cast("date")))


def in_window(begin: Column, end: Column, date_from: DateLike, date_to: DateLike) -> Column:
    """Overlap of ``[begin, end]`` with the days ``[date_from, date_to]``, last day included.

    A bound that is absent, as a Python value or as NULL in a column, is open. A granule without an
    end counts as a point.
    """
    window = temporal_range(date_from, date_to)
    if window is None:
        return F.lit(True)
    low, high = window
    tests = []
    if high is not None:
        day = high if isinstance(high, Column) else parse_day(high)
        tests.append(_open(high, begin < F.date_add(day, 1).cast("timestamp")))
    if low is not None:
        day = low if isinstance(low, Column) else parse_day(low)
        tests.append(_open(low, F.coalesce(end, begin) >= day.cast("timestamp")))
    return tests[0] if len(tests) == 1 else tests[0] & tests[1]


def _open(bound: DateLike, test: Column) -> Column:
    return (bound.isNull() | test) if isinstance(bound, Column) else test


def utc_timestamp(c: Column) -> Column:
    """ISO text as an instant; text without a zone is UTC whatever the session's zone is."""
    return F.to_timestamp(
        F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.concat(c, F.lit("T00:00:00Z")))
        .when(c.rlike(r"\d\d:\d\d(:\d\d(\.\d+)?)?$") & ~c.rlike(r"[+-]\d\d:\d\d$"),
              F.concat(c, F.lit("Z")))
        .otherwise(c))


def sub_micros(c: Column) -> Column:
    """Nanoseconds beyond the last whole microsecond of an ISO text; a timestamp drops them."""
    digits = F.rpad(F.regexp_extract(c, r"\.\d{6}(\d{1,3})", 1), 3, "0")
    return F.coalesce(digits.cast("int"), F.lit(0))


def epoch_seconds(c: Column) -> Column:
    """Whole seconds since 1970-01-01 UTC, rounded down."""
    return F.unix_seconds(utc_timestamp(c))


def report_key(prefix: Column, ts: Column, key: Column | None = None,
               stem: str = "virtual_collections", ext: str = "csv") -> Column:
    """``prefix/stem_<UTC stamp>.ext`` unless a key is given."""
    stamped = F.concat(F.regexp_replace(prefix, "/+$", ""), F.lit(f"/{stem}_"),
                       F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'"), F.lit(f".{ext}"))
    return stamped if key is None else F.coalesce(F.nullif(key, F.lit("")), stamped)
