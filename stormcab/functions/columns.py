"""Shared column expressions.

Every expression here is a native Catalyst expression (no Python UDF), so it
stays inside whole-stage codegen.  Calendar helpers work on TIMESTAMP_NTZ by
field arithmetic and never through the session time zone: a local wall-clock
hour such as 02:30 on a spring-forward day must stay in hour 02.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- calendar ----------------------------------------------------------------

def hour_floor(ts: ColumnOrName) -> Column:
    """Truncate a TIMESTAMP_NTZ to its hour, independent of the session zone."""
    t = _c(ts)
    return t.cast("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(t))


def date_hour_key(ts: ColumnOrName) -> Column:
    """BIGINT yyyyMMddHH of a timestamp (what TO_CHAR(ts,'YYYYMMDDHH24')::BIGINT gives)."""
    t = _c(ts)
    return (F.year(t).cast("bigint") * 1000000 + F.month(t) * 10000
            + F.dayofmonth(t) * 100 + F.hour(t))


def date_key(d: ColumnOrName) -> Column:
    """BIGINT yyyyMMdd of a date or timestamp."""
    t = _c(d)
    return F.year(t).cast("bigint") * 10000 + F.month(t) * 100 + F.dayofmonth(t)


def iso_weekday(ts: ColumnOrName) -> Column:
    """ISO day of week, Monday = 1 .. Sunday = 7."""
    return (F.weekday(_c(ts)) + 1).cast("int")


def is_weekend(ts: ColumnOrName) -> Column:
    return iso_weekday(ts).isin(*fixed.WEEKEND_ISO_DAYS)


def is_rush_hour(ts: ColumnOrName) -> Column:
    """True for local times in [07:00,10:00) or [16:00,20:00); equals the hour test."""
    return F.hour(_c(ts)).isin(*fixed.RUSH_HOURS)


def _clock_micros(ts: ColumnOrName) -> Column:
    """Microseconds of a TIMESTAMP_NTZ since 1970-01-01 00:00 on the same clock, by its fields."""
    t = _c(ts)
    seconds = F.unix_date(t.cast("date")).cast("bigint") * 86400 + F.hour(t) * 3600 + F.minute(t) * 60
    return seconds * 1000000 + (F.date_part(F.lit("SECOND"), t) * 1000000).cast("bigint")


def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Fractional minutes of wall-clock time from start to end, whatever the session zone."""
    return (_clock_micros(end) - _clock_micros(start)).cast("double") / F.lit(60000000.0)


def microseconds(minutes: ColumnOrName) -> Column:
    """Minutes that come from whole microseconds, as that integer: its sums are exact."""
    return F.round(_c(minutes) * F.lit(60000000.0)).cast("bigint")


# --- code lookups -------------------------------------------------------------

def code_name(code: ColumnOrName, names: dict[int, str], default: str) -> Column:
    """CASE code WHEN k THEN name ... ELSE default END."""
    c = _c(code)
    expr = None
    for k, v in names.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def payment_type_name(code: ColumnOrName) -> Column:
    return code_name(code, fixed.PAYMENT_TYPE_NAMES, fixed.UNKNOWN_PAYMENT)


def rate_code_name(code: ColumnOrName) -> Column:
    return code_name(code, fixed.RATE_CODE_NAMES, fixed.UNKNOWN_PAYMENT)


# --- weather ------------------------------------------------------------------

def weather_severity(precipitation_mm: ColumnOrName, snowfall_cm: ColumnOrName) -> Column:
    """Severity from precipitation (mm) and snowfall (cm); NULL counts as 0."""
    p = F.coalesce(_c(precipitation_mm), F.lit(0))
    s = F.coalesce(_c(snowfall_cm), F.lit(0))
    return (F.when((p >= fixed.SEVERE_PRECIPITATION_MM) | (s >= fixed.SEVERE_SNOWFALL_CM), F.lit("severe"))
            .when((p >= fixed.MODERATE_PRECIPITATION_MM) | (s >= fixed.MODERATE_SNOWFALL_CM), F.lit("moderate"))
            .when((p > 0) | (s > 0), F.lit("light"))
            .otherwise(F.lit("clear")))


def positive_flag(c: ColumnOrName) -> Column:
    """COALESCE(c, 0) > 0."""
    return F.coalesce(_c(c), F.lit(0)) > 0


def weather_key(weathercode: ColumnOrName, severity: ColumnOrName,
                is_rain: ColumnOrName, is_snow: ColumnOrName) -> Column:
    """MD5 of 'code-or-na|severity|rain|snow' (one definition for dim and fact)."""
    return md5_key(F.coalesce(_c(weathercode).cast("string"), F.lit("na")),
                   _c(severity), _c(is_rain).cast("string"), _c(is_snow).cast("string"))


def weather_group(is_rain: ColumnOrName, is_snow: ColumnOrName, severity: ColumnOrName) -> Column:
    r, s = _c(is_rain), _c(is_snow)
    return (F.when(r & s, F.lit("mixed"))
            .when(s, F.lit("snow"))
            .when(r, F.lit("rain"))
            .when(_c(severity) == "clear", F.lit("clear"))
            .otherwise(F.lit("other")))


# --- keys and numbers -----------------------------------------------------------

def md5_key(*parts: ColumnOrName) -> Column:
    """MD5 of the parts joined by '|'; NULL if any part is NULL (SQL `||`)."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit("|"))
        cols.append(_c(p).cast("string"))
    return F.md5(F.concat(*cols))


def md5_nullsafe(parts: Iterable[Column]) -> Column:
    """MD5 of the parts joined by '|', each NULL written as 'null'."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))


def mean_exact(c: ColumnOrName) -> Column:
    """Average as DOUBLE from an exact (decimal or integer) sum.

    The sum of decimals is exact whatever the partitioning, so the result is
    the same bits on every run and every cluster size; NULLs are skipped like
    AVG does and an all-NULL group gives NULL.
    """
    x = _c(c)
    return F.sum(x).cast("double") / F.count(x).cast("double")


def nonneg_or_zero(c: ColumnOrName, dtype: str) -> Column:
    """GREATEST(COALESCE(c, 0), 0) kept in the declared type."""
    return F.greatest(F.coalesce(_c(c), F.lit(0)), F.lit(0)).cast(dtype)


def ts_text(ts: ColumnOrName, iso_minutes: bool = False) -> Column:
    """Text of a TIMESTAMP_NTZ, zone-independent and without String.format.

    'yyyy-MM-dd HH:mm:ss' (fraction dropped) by default, 'yyyy-MM-ddTHH:mm'
    for weather payloads.  Casting NTZ to text never consults the session
    zone, unlike date_format; NULL stays NULL.
    """
    text = F.substring(_c(ts).cast("timestamp_ntz").cast("string"), 1, 19)
    if iso_minutes:
        return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 5))
    return text
