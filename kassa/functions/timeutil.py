"""Local days and months from UTC instants, and instant ranges from local days.

Instants are ``timestamp_ntz`` holding UTC.  A local day is derived with an
explicit zone, never with the session zone.  Range bounds are computed on the
driver from (day, zone) as literals and compared with the raw column, so the
comparison is pushed into the parquet scan.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the reporting zone.
REPORT_TZ = "Asia/Jakarta"
UTC = ZoneInfo("UTC")


def local_time(col: Column | str, tz: str = REPORT_TZ) -> Column:
    """UTC wall clock -> wall clock in ``tz`` (both ``timestamp_ntz``)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), c)


def local_date(col: Column | str, tz: str = REPORT_TZ) -> Column:
    return F.to_date(local_time(col, tz))


def local_month(col: Column | str, tz: str = REPORT_TZ) -> Column:
    return F.trunc(local_date(col, tz), "MM")


def utc_instant(day: dt.date, tz: str = REPORT_TZ) -> dt.datetime:
    """Local midnight of ``day`` in ``tz`` as a naive UTC datetime."""
    local = dt.datetime.combine(day, dt.time(), tzinfo=ZoneInfo(tz))
    return local.astimezone(UTC).replace(tzinfo=None)


def ts_literal(value: dt.datetime) -> Column:
    """A ``timestamp_ntz`` literal, independent of the session zone."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def date_literal(value: dt.date) -> Column:
    return F.lit(value.isoformat()).cast("date")


def instant_range(col: Column | str, start_day: dt.date, end_day: dt.date, tz: str = REPORT_TZ) -> Column:
    """``col`` within [local midnight of start_day, local midnight of end_day)."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= ts_literal(utc_instant(start_day, tz))) & (c < ts_literal(utc_instant(end_day, tz)))


def micros_between(start: Column, end: Column) -> Column:
    """end - start in microseconds for ``timestamp_ntz`` values, exact and
    independent of the session zone (the difference is a day-time interval)."""
    d = end - start
    return (
        F.extract(F.lit("DAY"), d).cast("long") * 86_400_000_000
        + F.extract(F.lit("HOUR"), d).cast("long") * 3_600_000_000
        + F.extract(F.lit("MINUTE"), d).cast("long") * 60_000_000
        + (F.extract(F.lit("SECOND"), d) * 1_000_000).cast("long")
    )


EPOCH_NTZ = "1970-01-01 00:00:00"
MICROS_PER_DAY = 86_400_000_000


def instant(col: Column | str) -> Column:
    """``timestamp_ntz`` holding UTC -> ``timestamp`` (an instant), via epoch
    microseconds so the session zone plays no part (streaming event time
    must be a ``timestamp``)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_micros(micros_between(F.lit(EPOCH_NTZ).cast("timestamp_ntz"), c))


def day_of_instant(col: Column | str, offset_hours: int) -> Column:
    """Calendar day at a fixed UTC offset of a ``timestamp`` value."""
    c = F.col(col) if isinstance(col, str) else col
    days = F.floor((F.unix_micros(c) + offset_hours * 3_600_000_000) / MICROS_PER_DAY).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def add_months(day: dt.date, months: int) -> dt.date:
    idx = day.year * 12 + (day.month - 1) + months
    return dt.date(idx // 12, idx % 12 + 1, 1) if day.day == 1 else _add_months_any(day, idx)


def _add_months_any(day: dt.date, idx: int) -> dt.date:
    year, month = idx // 12, idx % 12 + 1
    nxt = dt.date(year + (month == 12), month % 12 + 1, 1)
    last = (nxt - dt.timedelta(days=1)).day
    return dt.date(year, month, min(day.day, last))


def month_start(day: dt.date) -> dt.date:
    return day.replace(day=1)


def yesterday_in(now_utc: dt.datetime, tz: str = REPORT_TZ) -> dt.date:
    """The local calendar day before ``now_utc`` (an aware or naive-UTC datetime)."""
    if now_utc.tzinfo is None:
        now_utc = now_utc.replace(tzinfo=UTC)
    return now_utc.astimezone(ZoneInfo(tz)).date() - dt.timedelta(days=1)
