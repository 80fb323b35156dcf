"""Wall-clock (TIMESTAMP_NTZ) time helpers that never consult the session time zone.

``date_trunc`` and ``to_utc_timestamp`` return instants on NTZ input, and ``timestampdiff`` on NTZ follows the
session zone in a DST transition; everything here is pure wall-clock arithmetic, so results are identical in
a UTC, New-York or Manila session.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_to_utc(ts, tz: str) -> Column:
    """Local wall clock in ``tz`` → UTC wall clock (DST aware; a gap time is shifted forward)."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), _c(ts))


def utc_to_local(ts, tz: str) -> Column:
    """UTC wall clock → local wall clock in ``tz``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts))


def truncate_hour(ts) -> Column:
    """Start of the hour, staying NTZ: the day's start and its hours, without a decimal of seconds per row."""
    t = _c(ts)
    return F.to_date(t).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(t))


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end`` on the wall clock, truncated toward zero (``timestampdiff``)."""
    # the difference of two NTZ values never consults the session zone; its cast to whole seconds drops the fraction
    return (_c(end).cast("timestamp_ntz") - _c(start).cast("timestamp_ntz")).cast("interval second").cast("long")


def nonexistent_local_flag(ts, tz: str) -> Column:
    """True when a local wall-clock time falls in the spring-forward gap (it does not survive a round trip)."""
    t = _c(ts)
    return F.coalesce(utc_to_local(local_to_utc(t, tz), tz) != t, F.lit(False))


def ambiguous_local_flag(ts, tz: str) -> Column:
    """True when a local wall-clock time occurs twice (fall-back overlap)."""
    t = _c(ts)
    later = local_to_utc(t, tz) + F.expr("INTERVAL 1 HOUR")
    return F.coalesce(utc_to_local(later, tz) == t, F.lit(False))


def ntz_literal(text: str) -> Column:
    """An NTZ literal for window predicates against NTZ columns."""
    return F.to_timestamp_ntz(F.lit(text))


def in_half_open_window(ts, lo: str, hi: str) -> Column:
    """``lo <= ts < hi`` with NTZ bounds, two-valued."""
    t = _c(ts)
    return F.coalesce((t >= ntz_literal(lo)) & (t < ntz_literal(hi)), F.lit(False))


def yyyymm(ts) -> Column:
    return F.date_format(_c(ts), "yyyy-MM")


def date_key(d) -> Column:
    """``yyyyMMdd`` integer key of a date/timestamp."""
    x = F.to_date(_c(d))
    return (F.year(x) * 10000 + F.month(x) * 100 + F.dayofmonth(x)).cast("int")
