"""Scalar rules as native column expressions (no Python UDF anywhere).

Timestamps are ``TIMESTAMP_NTZ`` holding UTC.  Local attributes go through
``convert_timezone``, which does not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from delaystar import settings as S

__all__ = [
    "local_time",
    "local_hour",
    "date_key",
    "delay_minutes",
    "warehouse_category",
    "operational_category",
    "time_period",
    "delay_seconds_between",
    "prediction_fallback",
    "display_category",
    "route_number_from_id",
    "normalized_headsign",
    "clean_headsign",
    "history_text",
    "local_clock",
    "strip",
    "epoch_to_time",
    "epoch_seconds",
    "safe_date",
    "kpi_target_flag",
    "percent_text",
    "minutes_text",
    "rounded_mean",
    "is_delayed",
    "is_significant_or_severe",
    "day_of_week_sunday_first",
    "nonblank",
    "idiv",
    "truncate_hour",
    "ntz_literal",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(a: Column, b: Column) -> Column:
    """Exact integer division (SQL ``a div b``)."""
    return F.call_function("div", a, b)


def nonblank(c: Column | str) -> Column:
    """NULL for NULL or empty text (``NULLIF(x, '')``)."""
    return F.nullif(_col(c), F.lit(""))


# F14 local wall clock and hour
def local_time(ts: Column | str, zone: str = S.LOCAL_ZONE) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts))


def local_hour(ts: Column | str, zone: str = S.LOCAL_ZONE) -> Column:
    return F.hour(local_time(ts, zone))


# F1 date key YYYYMMDD of the local date
def date_key(ts: Column | str, zone: str = S.LOCAL_ZONE) -> Column:
    lt = local_time(ts, zone)
    return (F.year(lt) * 10000 + F.month(lt) * 100 + F.dayofmonth(lt)).cast("bigint")


# F2
def delay_minutes(seconds: Column | str) -> Column:
    return (_col(seconds) / F.lit(60.0)).cast("double")


# F3 warehouse category
def warehouse_category(seconds: Column | str) -> Column:
    s = _col(seconds)
    return (
        F.when(s <= S.WAREHOUSE_ON_TIME_MAX, S.ON_TIME)
        .when(s <= S.WAREHOUSE_MINOR_MAX, S.MINOR_DELAY)
        .when(s <= S.WAREHOUSE_SIGNIFICANT_MAX, S.SIGNIFICANT_DELAY)
        .otherwise(S.SEVERE_DELAY)
    )


# F4 operational category (NULL stays NULL)
def operational_category(seconds: Column | str) -> Column:
    s = _col(seconds)
    early, on_time, minor, medium, major = S.OPERATIONAL_CATEGORIES
    return (
        F.when(s < S.OPERATIONAL_EARLY_BELOW, early)
        .when(s <= S.OPERATIONAL_ON_TIME_MAX, on_time)
        .when(s <= S.OPERATIONAL_MINOR_MAX, minor)
        .when(s <= S.OPERATIONAL_MEDIUM_MAX, medium)
        .when(s > S.OPERATIONAL_MEDIUM_MAX, major)
    )


# F5 time period of an hour (both bounds inclusive)
def time_period(hour: Column | str) -> Column:
    h = _col(hour)
    m_name, m_lo, m_hi = S.MORNING_PEAK
    a_name, a_lo, a_hi = S.AFTERNOON_PEAK
    return (
        F.when(h.between(m_lo, m_hi), m_name)
        .when(h.between(a_lo, a_hi), a_name)
        .otherwise(S.OTHER_PERIOD)
    )


# F6 whole seconds predicted - scheduled, truncated toward zero
def delay_seconds_between(scheduled: Column | str, predicted: Column | str) -> Column:
    return F.timestamp_diff("SECOND", _col(scheduled), _col(predicted))


# F7 missing prediction falls back to the schedule
def prediction_fallback(predicted: Column | str, scheduled: Column | str) -> Column:
    return F.coalesce(_col(predicted), _col(scheduled))


def is_delayed(seconds: Column | str) -> Column:
    return _col(seconds) > S.DELAYED_ABOVE_SECONDS


# F8 display category of an operational observation
def display_category(category: Column | str, seconds: Column | str) -> Column:
    name = F.translate(F.lower(strip(category)), "_", " ")
    s = _col(seconds)
    major_name, major_as = S.MAJOR_DELAY_DISPLAY
    return (
        F.when(name.isin(*S.CATEGORY_ORDER), name)
        .when(name == major_name, F.lit(major_as))
        .otherwise(warehouse_category(s))
    )


def is_significant_or_severe(category: Column) -> Column:
    return category.isin(*S.SIGNIFICANT_OR_SEVERE)


# F9 route number from a route id: digits 3040/4 (or ending 3040) -> '4',
# 3060/6 (or ending 3060) -> '6', else a trailing single 4/6 not preceded by
# a digit, else ''.
def route_number_from_id(route_id: Column | str) -> Column:
    rid = strip(route_id)
    digits = F.regexp_replace(rid, r"[^0-9]", "")
    expr = None
    for number, exact, suffix in S.ROUTE_NUMBER_CODES:
        cond = digits.isin(*exact) | digits.endswith(suffix)
        expr = F.when(cond, F.lit(number)) if expr is None else expr.when(cond, F.lit(number))
    return expr.otherwise(F.regexp_extract(rid, S.TRAILING_ROUTE_NUMBER_PATTERN, 1))


# F10 normalized headsign (trim, empty -> unknown, accent/case-insensitive merge)
def normalized_headsign(headsign: Column | str) -> Column:
    h = strip(F.coalesce(_col(headsign), F.lit("")))
    folded = F.collate(h, "UNICODE_CI_AI")
    merged = F.lit(False)
    for key in S.MERGED_HEADSIGN_KEYS:
        merged = merged | (folded == F.lit(key))
    return (
        F.when(h == "", F.lit(S.UNKNOWN_HEADSIGN))
        .when(merged, F.lit(S.MERGED_HEADSIGN))
        .otherwise(h)
        .cast("string")
    )


# F11
def clean_headsign(headsign: Column | str) -> Column:
    return F.coalesce(nonblank(headsign), F.lit(S.UNKNOWN_HEADSIGN))


# F19/F20 display helpers
def history_text(c: Column | str) -> Column:
    return F.coalesce(nonblank(c), F.lit(S.MISSING_TEXT))


def local_clock(ts: Column | str, zone: str = S.LOCAL_ZONE) -> Column:
    """HH:mm of a UTC instant in the local zone; '-' when missing."""
    # text of the NTZ value, not date_format (which shifts times in the session zone's DST gap)
    return F.coalesce(F.substring(local_time(ts, zone).cast("string"), 12, 5), F.lit(S.MISSING_TEXT))


# White space of any kind off both ends (``trim`` takes blanks only)
def strip(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


# F22 epoch seconds <-> UTC instant (NTZ)
def epoch_seconds(ts: Column | str) -> Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _col(ts))


def epoch_to_time(epoch: Column | str) -> Column:
    return F.timestamp_add("SECOND", _col(epoch), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


# Hour truncation that stays TIMESTAMP_NTZ (independent of the session zone)
def truncate_hour(ts: Column | str) -> Column:
    t = _col(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal parsed from text (no session-zone conversion)."""
    return F.lit(value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)).cast("timestamp_ntz")


# F27
def safe_date(c: Column | str) -> Column:
    return F.try_to_date(F.substring(_col(c).cast("string"), 1, 10), "yyyy-MM-dd")


# F15 day of week with Sunday = 1
def day_of_week_sunday_first(d: Column | str) -> Column:
    return F.dayofweek(_col(d))


# F28
def kpi_target_flag(avg_minutes: Column | str) -> Column:
    return F.when(_col(avg_minutes) < S.KPI_TARGET_MINUTES, S.KPI_TARGET_OK).otherwise(S.KPI_TARGET_WARNING)


# F29 "12.3%" and "2.25 min"; rounding is done in integers (half up)
def percent_text(numerator: Column | str, denominator: Column | str) -> Column:
    num, den = _col(numerator).cast("bigint"), _col(denominator).cast("bigint")
    tenths = idiv(num * 2000 + den, den * 2)
    return F.when(den > 0, F.format_string("%d.%d%%", idiv(tenths, F.lit(10)), tenths % 10))


def minutes_text(avg_minutes: Column | str) -> Column:
    return F.format_string("%.2f min", _col(avg_minutes))


# Mean of integer seconds in minutes rounded half away from zero to 2 places,
# computed in integers so every engine returns the same double.
def rounded_mean(sum_seconds: Column | str, count: Column | str, divisor_seconds: int = 60) -> Column:
    s, n = _col(sum_seconds).cast("bigint"), _col(count).cast("bigint")
    d = divisor_seconds
    q = idiv(F.abs(s) * 200 + n * d, n * (2 * d))
    return F.when(n > 0, F.when(s < 0, -q).otherwise(q) / F.lit(100.0))
