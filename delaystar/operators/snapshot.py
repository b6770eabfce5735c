"""Snapshot statistics over operational observations (C9, A17..A25).

Rules differ from the warehouse view on purpose: the scope comes from the
route id (F9), negative delays are kept, categories come from the collected
category name (F8), groups key on stop id + stop name (or id) + normalized
headsign (F10), the day is the UTC date of ``created_at``, the hour is local,
and the time period comes from the scheduled departure.  Python's banker's
rounding of the source is replaced by half-away-from-zero (integer form).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from delaystar import settings as S
from delaystar.functions import columns as C
from delaystar.operators.onepass import one_pass, stacked
from delaystar.operators.reporting import category_rank, hour_spine

GROUP_KEY = ("stop_id", "stop_name", "headsign")


def snapshot_input(observations: DataFrame, stops: DataFrame, zone: str = S.LOCAL_ZONE) -> DataFrame:
    """P7 scope + stop-name lookup + per-row derived fields.

    The stop table (one row per stop of the network) is broadcast by the planner
    when it is below the byte threshold.
    """
    names = stops.select(F.col("id").alias("stop_id"), F.col("name").alias("_stop_name"))
    scoped = observations.filter(
        F.col("created_at").isNotNull() & F.col("delay_seconds").isNotNull()
        & C.route_number_from_id("route_id").isin(*S.REPORT_ROUTE_NUMBERS)
    )
    display = C.display_category("delay_category", "delay_seconds")
    return scoped.join(names, on="stop_id", how="left").select(
        "stop_id",
        F.coalesce("_stop_name", "stop_id").alias("stop_name"),
        C.normalized_headsign("headsign").alias("headsign"),
        C.route_number_from_id("route_id").alias("route_number"),
        F.col("delay_seconds").cast("bigint").alias("delay_seconds"),
        C.is_delayed("delay_seconds").alias("is_delayed"),
        display.alias("display_category"),
        C.is_significant_or_severe(display).alias("is_sig"),
        F.to_date("created_at").alias("created_date"),
        C.local_hour("created_at", zone).alias("observed_hour"),
        C.time_period(C.local_hour("scheduled_departure", zone)).alias("time_period"),
        C.truncate_hour("scheduled_departure").alias("period_start"),
    )


def _stats() -> list:
    return [
        F.sum("delay_seconds").alias("_s"),
        F.count(F.lit(1)).alias("observation_count"),
        F.count_if("is_delayed").alias("_delayed"),
        F.count_if("is_sig").cast("bigint").alias("_sig"),
    ]


# A17
def snap_kpi(snap: DataFrame) -> DataFrame:
    return _finish_kpi(snap.agg(*_stats(), F.max("delay_seconds").alias("_max")))


def _finish_kpi(g: DataFrame) -> DataFrame:
    return g.filter(F.col("observation_count") > 0).select(
        C.rounded_mean("_s", "observation_count").alias("avg_delay_minutes"),
        C.rounded_mean("_max", F.lit(1)).alias("max_delay_minutes"),
        "observation_count",
        (F.col("_delayed") / F.col("observation_count")).alias("delayed_ratio"),
        F.col("_sig").alias("significant_or_severe_count"),
    )


def _stop_groups(snap: DataFrame) -> DataFrame:
    return snap.groupBy(*GROUP_KEY).agg(*_stats())


# Top 10 by (avg, sig) desc; ties keep ascending group key
def snap_stop_ranking(snap: DataFrame, limit: int = S.SNAPSHOT_RANKING_LIMIT) -> DataFrame:
    return _finish_ranking(_stop_groups(snap), limit)


def _finish_ranking(groups: DataFrame, limit: int) -> DataFrame:
    g = groups.select(
        *GROUP_KEY,
        C.rounded_mean("_s", "observation_count").alias("avg_delay_minutes"),
        F.col("_sig").alias("significant_or_severe_count"),
        "observation_count",
    )
    ranked = g.orderBy(
        F.col("avg_delay_minutes").desc(), F.col("significant_or_severe_count").desc(),
        *[F.col(k).asc() for k in GROUP_KEY],
    ).limit(limit)
    return ranked.select("stop_name", "headsign", "avg_delay_minutes", "significant_or_severe_count",
                         "observation_count")


# UTC calendar day (no zone conversion) x route number
def snap_daily_trend(snap: DataFrame) -> DataFrame:
    return _finish_daily(snap.groupBy("created_date", "route_number").agg(*_stats()))


def _finish_daily(g: DataFrame) -> DataFrame:
    return g.select(
        F.col("created_date").alias("calendar_date"), "route_number",
        C.rounded_mean("_s", "observation_count").alias("avg_delay_minutes"), "observation_count",
    ).orderBy("calendar_date", "route_number")


# Local hour, 24 dense rows (none when there is no observation)
def snap_hourly_trend(snap: DataFrame) -> DataFrame:
    return _finish_hourly(snap.groupBy("observed_hour").agg(*_stats()))


def _finish_hourly(g: DataFrame) -> DataFrame:
    """Dense hours of the grouped rows; the groups themselves (24 at most) say whether there was an observation."""
    met = F.max(F.col("observation_count").isNotNull()).over(Window.partitionBy())
    return (
        hour_spine(g.sparkSession).join(g, on="observed_hour", how="left")
        .withColumn("_any", met).where("_any")
        .select(
            "observed_hour",
            F.coalesce(C.rounded_mean("_s", "observation_count"), F.lit(0.0)).alias("avg_delay_minutes"),
            F.coalesce("observation_count", F.lit(0)).cast("bigint").alias("observation_count"),
        )
        .orderBy("observed_hour")
    )


# A21
def snap_category_breakdown(snap: DataFrame) -> DataFrame:
    g = snap.groupBy(F.col("display_category").alias("delay_category")).agg(
        F.count(F.lit(1)).alias("observation_count"))
    return g.orderBy(category_rank(), "delay_category")


# Route number x period of the scheduled departure
def snap_time_period_matrix(snap: DataFrame) -> DataFrame:
    return _finish_matrix(snap.groupBy("route_number", "time_period").agg(*_stats()))


def _finish_matrix(g: DataFrame) -> DataFrame:
    return g.select(
        "route_number", "time_period",
        C.rounded_mean("_s", "observation_count").alias("avg_delay_minutes"), "observation_count",
    ).orderBy("route_number", "time_period")


# A23
def average_delay_by_stop(snap: DataFrame) -> DataFrame:
    return _finish_average(_stop_groups(snap))


def _finish_average(groups: DataFrame) -> DataFrame:
    return groups.select(
        *GROUP_KEY, "observation_count",
        (F.col("_s") / F.col("observation_count")).alias("average_delay_seconds"),
    ).orderBy(*GROUP_KEY)


# Hour-truncated scheduled departure
def delayed_ratio_by_period(snap: DataFrame) -> DataFrame:
    return _finish_periods(snap.groupBy("period_start").agg(*_stats()))


def _finish_periods(g: DataFrame) -> DataFrame:
    return g.select(
        "period_start", "observation_count",
        F.col("_delayed").alias("delayed_count"),
        (F.col("_delayed") / F.col("observation_count")).alias("delayed_ratio"),
        (F.col("_s") / F.col("observation_count")).alias("average_delay_seconds"),
    ).orderBy("period_start")


# Sorted by group key, not by severity
def most_problematic_stops(snap: DataFrame) -> DataFrame:
    return _finish_problematic(_stop_groups(snap))


def _finish_problematic(groups: DataFrame) -> DataFrame:
    return groups.select(
        *GROUP_KEY, "observation_count",
        (F.col("_s") / F.col("observation_count")).alias("average_delay_seconds"),
        (F.col("_delayed") / F.col("observation_count")).alias("delayed_ratio"),
        F.col("_sig").alias("major_delay_count"),
    ).orderBy(*GROUP_KEY)


# Nine parts, the observations are read once
def statistics_from_observations(
    spark: SparkSession, observations: DataFrame, stops: DataFrame, zone: str = S.LOCAL_ZONE
) -> dict[str, DataFrame]:
    return statistics_of(snapshot_input(observations, stops, zone))


def statistics_of(snap: DataFrame) -> dict[str, DataFrame]:
    flag = lambda c: F.when(F.col(c), 1).otherwise(0).cast("bigint")
    rows = snap.select(
        *GROUP_KEY, "created_date", "route_number", "observed_hour", F.col("display_category").alias("delay_category"),
        "time_period", "period_start", F.col("delay_seconds").alias("_s"), F.col("delay_seconds").alias("_max"),
        F.lit(1).cast("bigint").alias("observation_count"), flag("is_delayed").alias("_delayed"), flag("is_sig").alias("_sig"))
    groupings = ((), GROUP_KEY, ("created_date", "route_number"), ("observed_hour",), ("delay_category",),
                 ("route_number", "time_period"), ("period_start",))
    parts = one_pass(rows, groupings, ("_s", "observation_count", "_delayed", "_sig"), ("_max",))
    stop_groups = parts.part(*GROUP_KEY)
    categories = parts.part("delay_category").select("delay_category", "observation_count")
    return {
        "kpi_summary": _finish_kpi(parts.part()),
        "stop_delay_ranking": _finish_ranking(stop_groups, S.SNAPSHOT_RANKING_LIMIT),
        "daily_delay_trend": _finish_daily(parts.part("created_date", "route_number")),
        "hourly_delay_trend": _finish_hourly(parts.part("observed_hour")),
        "delay_category_breakdown": categories.orderBy(category_rank(), "delay_category"),
        "time_period_delay_matrix": _finish_matrix(parts.part("route_number", "time_period")),
        "average_delay_by_stop": _finish_average(stop_groups),
        "delayed_ratio_by_period": _finish_periods(parts.part("period_start")),
        "most_problematic_stops": _finish_problematic(stop_groups),
    }


# C9 as one table
def snapshot_statistics(snap: DataFrame) -> DataFrame:
    return stacked(statistics_of(snap))
