"""Star schema build: dim_date, dim_route, dim_stop, fact and the reporting view.

Plan shape: the fact is one narrow projection of the usable raw rows followed by
two inner equi-joins against materialized dimensions.  Their files tell the
planner their size, so a dimension below the broadcast threshold leaves the big
side unshuffled.  The view adds the date dimension the same way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaystar import settings as S
from delaystar.functions import columns as C
from delaystar.session import dimension

FACT_COLUMNS = (
    "source_observation_id",
    "date_key",
    "route_key",
    "stop_key",
    "collection_run_id",
    "trip_id",
    "headsign",
    "direction_id",
    "stop_sequence",
    "observed_at",
    "scheduled_departure",
    "predicted_departure",
    "delay_seconds",
    "delay_minutes",
    "delay_category",
    "source_delay_category",
    "time_period",
    "observation_count",
)


# P1 / C5
def build_dim_route(routes: DataFrame) -> DataFrame:
    return routes.select(
        F.col("id").cast("string").alias("route_key"),
        F.col("id").cast("string").alias("source_route_id"),
        F.col("short_name").cast("string").alias("route_number"),
        F.concat(F.col("route_type"), F.lit(S.ROUTE_NAME_INFIX), F.col("short_name")).cast("string").alias("route_name"),
        F.col("route_type").cast("string").alias("route_type"),
    )


# P2 / C5
def build_dim_stop(stops: DataFrame) -> DataFrame:
    return stops.select(
        F.col("id").cast("string").alias("stop_key"),
        F.col("id").cast("string").alias("source_stop_id"),
        F.col("name").cast("string").alias("stop_name"),
        F.col("lat").try_cast("double").alias("lat"),
        F.col("lon").try_cast("double").alias("lon"),
    )


# F15 calendar attributes of a date column
def calendar_attributes(d: str = "calendar_date") -> list:
    dow = C.day_of_week_sunday_first(d)
    return [
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint").alias("date_key"),
        F.col(d).alias("calendar_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        dow.alias("day_of_week_number"),
        F.when(dow.isin(*S.WEEKEND_DAYS), S.WEEKEND).otherwise(S.WEEKDAY).alias("day_type"),
    ]


# Local-date bounds of the raw history, one row per day
def build_dim_date(raw: DataFrame, zone: str = S.LOCAL_ZONE) -> DataFrame:
    bounds = raw.agg(
        F.to_date(C.local_time(F.min("created_at"), zone)).alias("start_date"),
        F.to_date(C.local_time(F.max("created_at"), zone)).alias("end_date"),
    )
    days = bounds.select(F.explode(F.sequence("start_date", "end_date")).alias("calendar_date"))
    return days.select(*calendar_attributes("calendar_date"))


# P3
def usable_filter(raw: DataFrame) -> DataFrame:
    return raw.filter(
        F.col("created_at").isNotNull() & F.col("delay_seconds").isNotNull() & (F.col("delay_seconds") >= 0)
    )


# Every derived fact column
def fact_derive(raw: DataFrame, zone: str = S.LOCAL_ZONE) -> DataFrame:
    secs = F.col("delay_seconds").cast("bigint")
    return raw.select(
        F.col("observation_id").alias("source_observation_id"),
        C.date_key("created_at", zone).alias("date_key"),
        "route_id",
        "stop_id",
        "collection_run_id",
        "trip_id",
        "headsign",
        "direction_id",
        F.col("stop_sequence").cast("bigint").alias("stop_sequence"),
        F.col("created_at").alias("observed_at"),
        "scheduled_departure",
        "predicted_departure",
        secs.alias("delay_seconds"),
        C.delay_minutes(secs).alias("delay_minutes"),
        C.warehouse_category(secs).alias("delay_category"),
        F.col("delay_category").alias("source_delay_category"),
        C.time_period(C.local_hour("created_at", zone)).alias("time_period"),
        F.lit(1).cast("bigint").alias("observation_count"),
    )


# J1
def join_fact_route(fact: DataFrame, dim_route: DataFrame) -> DataFrame:
    r = dim_route.select("route_key", F.col("source_route_id").alias("route_id"))
    return fact.join(r, on="route_id", how="inner")


# J2
def join_fact_stop(fact: DataFrame, dim_stop: DataFrame) -> DataFrame:
    s = dim_stop.select("stop_key", F.col("source_stop_id").alias("stop_id"))
    return fact.join(s, on="stop_id", how="inner")


# P5
def fact_output(df: DataFrame) -> DataFrame:
    return df.select(*FACT_COLUMNS)


def occurring(dim: DataFrame, key: str, rows: DataFrame, column: str | None = None) -> DataFrame:
    """The rows of a dimension whose ``key`` occurs in ``rows`` (in ``column``), written.

    A history names few of a large dimension's keys, some of them often.  Cut to these and written, the
    dimension is small and known to be, and the planner does not shuffle the history on them.
    """
    used = dimension(rows.select(F.col(column or key).alias(key)).distinct())
    return dimension(dim.join(used, key, "left_semi").select(*dim.columns))


# C6
def build_fact(raw: DataFrame, dim_route: DataFrame, dim_stop: DataFrame, zone: str = S.LOCAL_ZONE, stored: bool = False) -> DataFrame:
    """The fact of ``raw``; where that is ``stored`` (cheap to read again), the dimensions are first cut to its keys."""
    if stored:
        dim_route = occurring(dim_route, "source_route_id", raw, "route_id")
        dim_stop = occurring(dim_stop, "source_stop_id", raw, "stop_id")
    derived = fact_derive(usable_filter(raw), zone)
    return fact_output(join_fact_stop(join_fact_route(derived, dim_route), dim_stop))


@dataclass(frozen=True)
class Warehouse:
    dim_date: DataFrame
    dim_route: DataFrame
    dim_stop: DataFrame
    fact: DataFrame
    zone: str = S.LOCAL_ZONE


def build_warehouse(raw: DataFrame, routes: DataFrame, stops: DataFrame, zone: str = S.LOCAL_ZONE,
                    fact_zone: str | None = None, stored: bool = False) -> Warehouse:
    """Dimensions are written once; the planner broadcasts them when small.  ``stored``: as in :func:`build_fact`.

    ``fact_zone`` is the clock the fact recipe reads date/hour from; it defaults
    to ``zone``.  Setting it to UTC reproduces a recipe that skipped the zone
    conversion (the date dimension is always built in ``zone``), which the
    local-time checks must catch.
    """
    dim_route = dimension(build_dim_route(routes))
    dim_stop = dimension(build_dim_stop(stops))
    dim_date = dimension(build_dim_date(raw, zone))
    fact = build_fact(raw, dim_route, dim_stop, fact_zone or zone, stored)
    return Warehouse(dim_date, dim_route, dim_stop, fact, zone)


def _date_key_of(day: str) -> int:
    return int(day.replace("-", "")[:8])


def _local_date_range(fact: DataFrame, date_from: str | None, date_to: str | None):
    cond = F.lit(True)
    if date_from is not None:
        cond = cond & (F.col("date_key") >= _date_key_of(date_from))
    if date_to is not None:
        cond = cond & (F.col("date_key") <= _date_key_of(date_to))
    if "observed_date" in fact.columns:  # stored fact: prune UTC-date partitions
        if date_from is not None:
            cond = cond & (F.col("observed_date") >= F.date_sub(F.lit(date_from).cast("date"), 1))
        if date_to is not None:
            cond = cond & (F.col("observed_date") <= F.date_add(F.lit(date_to).cast("date"), 1))
    return cond


VIEW_COLUMNS = (
    "calendar_date", "year", "month", "month_name", "day_of_week_number", "day_type",
    "route_number", "route_name", "route_type",
    "stop_name", "lat", "lon",
    "collection_run_id", "trip_id", "headsign", "direction_id", "stop_sequence",
    "observed_at", "observed_at_budapest", "observed_hour",
    "scheduled_departure", "predicted_departure", "delay_seconds", "delay_minutes",
    "delay_category", "source_delay_category", "time_period", "observation_count",
    "delayed_count", "significant_or_severe_count",
)


# The shared reporting contract
def dashboard_view(wh: Warehouse, route_numbers: tuple[str, ...] | None = S.REPORT_ROUTE_NUMBERS,
                   date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """The reporting view; an optional local date range (inclusive) is applied on the
    fact: ``date_key`` bounds reach the scan, and on a stored fact the one-day-widened
    ``observed_date`` bounds prune UTC-date partitions."""
    routes = wh.dim_route
    fact = wh.fact
    if date_from is not None or date_to is not None:
        fact = fact.filter(_local_date_range(fact, date_from, date_to))
    if route_numbers is not None:
        routes = routes.filter(F.col("route_number").isin(*route_numbers))
    joined = (
        fact.join(wh.dim_date, on="date_key", how="inner")
        .join(routes, on="route_key", how="inner")
        .join(wh.dim_stop, on="stop_key", how="inner")
    )
    local = C.local_time("observed_at", wh.zone)
    return joined.select(
        "calendar_date", "year", "month", "month_name", "day_of_week_number", "day_type",
        "route_number", "route_name", "route_type",
        "stop_name", "lat", "lon",
        "collection_run_id", "trip_id", "headsign", "direction_id", "stop_sequence",
        "observed_at",
        local.alias("observed_at_budapest"),
        F.hour(local).alias("observed_hour"),
        "scheduled_departure", "predicted_departure", "delay_seconds", "delay_minutes",
        "delay_category", "source_delay_category", "time_period", "observation_count",
        F.when(C.is_delayed("delay_seconds"), 1).otherwise(0).cast("bigint").alias("delayed_count"),
        F.when(C.is_significant_or_severe(F.col("delay_category")), 1).otherwise(0).cast("bigint")
        .alias("significant_or_severe_count"),
    )


# The view under its name, for SQL
def register_dashboard_view(wh: Warehouse, name: str = S.DASHBOARD_VIEW_NAME) -> str:
    """Register the reporting view as a temporary view of the session; returns its name."""
    dashboard_view(wh).createOrReplaceTempView(name)
    return name
