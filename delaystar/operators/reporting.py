"""The six named statistics on the reporting view, plus page-level helpers.

Every average is rounded from an integer sum and a count (``rounded_mean``), so
results do not depend on the order in which partial sums are combined.  All
aggregations are partial+final (map-side combine); result sizes are bounded by
the number of groups (hours, categories, periods, routes x days).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from delaystar import settings as S
from delaystar.functions import columns as C
from delaystar.operators.onepass import one_pass, stacked
from delaystar.session import dimension
from delaystar.sources.snapshots import TableSet, newest_rows


def _minutes_aggs() -> list:
    return [
        F.sum("delay_seconds").alias("_sum_s"),
        F.count(F.col("delay_seconds")).alias("_n_s"),
    ]


def _finish_minutes(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_delay_minutes", C.rounded_mean("_sum_s", "_n_s")).drop("_sum_s", "_n_s")


def _named(column: str, default: str) -> F.Column:
    """A result record's text: a missing value has a default (empty, or ``unknown`` for periods and categories)."""
    return F.coalesce(F.col(column), F.lit(default)).alias(column)


# A1
def kpi_summary(view: DataFrame) -> DataFrame:
    return _finish_kpi(view.agg(
        F.sum("delay_seconds").alias("_sum_s"),
        F.count(F.col("delay_seconds")).alias("_n_s"),
        F.max("delay_seconds").alias("_max_s"),
        F.sum("observation_count").alias("_obs"),
        F.sum("delayed_count").alias("_delayed"),
        F.sum("significant_or_severe_count").alias("_sig"),
    ))


def _finish_kpi(agg: DataFrame) -> DataFrame:
    return agg.select(
        F.coalesce(C.rounded_mean("_sum_s", "_n_s"), F.lit(0.0)).alias("avg_delay_minutes"),
        F.coalesce(C.rounded_mean("_max_s", F.lit(1)), F.lit(0.0)).alias("max_delay_minutes"),
        F.coalesce(F.col("_obs"), F.lit(0)).cast("bigint").alias("observation_count"),
        F.coalesce(F.try_divide(F.col("_delayed"), F.col("_obs")), F.lit(0.0)).alias("delayed_ratio"),
        F.coalesce(F.col("_sig"), F.lit(0)).cast("bigint").alias("significant_or_severe_count"),
    )


# The headsign is cleaned before grouping
def stop_delay_ranking(view: DataFrame, limit: int = S.RANKING_LIMIT) -> DataFrame:
    grouped = (
        view.select(_named("stop_name", ""), C.clean_headsign("headsign").alias("headsign"), "delay_seconds",
                    "significant_or_severe_count", "observation_count")
        .groupBy("stop_name", "headsign")
        .agg(
            *_minutes_aggs(),
            F.sum("significant_or_severe_count").alias("significant_or_severe_count"),
            F.sum("observation_count").alias("observation_count"),
        )
    )
    return _finish_ranking(grouped, limit)


def _finish_ranking(grouped: DataFrame, limit: int) -> DataFrame:
    ranked = _finish_minutes(grouped).select(
        "stop_name", "headsign", "avg_delay_minutes", "significant_or_severe_count", "observation_count"
    )
    return ranked.orderBy(
        F.col("avg_delay_minutes").desc(), F.col("significant_or_severe_count").desc(),
        F.col("stop_name").asc(), F.col("headsign").asc(),
    ).limit(limit)


# A3
def daily_delay_trend(view: DataFrame) -> DataFrame:
    g = view.groupBy("calendar_date", _named("route_number", "")).agg(
        *_minutes_aggs(), F.sum("observation_count").alias("observation_count")
    )
    return _finish_daily(g)


def _finish_daily(g: DataFrame) -> DataFrame:
    return _finish_minutes(g).select("calendar_date", "route_number", "avg_delay_minutes", "observation_count") \
        .orderBy("calendar_date", "route_number")


def hour_spine(spark: SparkSession) -> DataFrame:
    """hours 0..23."""
    return spark.range(24).select(F.col("id").cast("int").alias("observed_hour"))


# A4 / J6
def hourly_delay_trend(view: DataFrame) -> DataFrame:
    g = view.groupBy("observed_hour").agg(*_minutes_aggs(), F.sum("observation_count").alias("observation_count"))
    return _finish_hourly(g)


def _finish_hourly(g: DataFrame) -> DataFrame:
    g = _finish_minutes(g)
    return (
        hour_spine(g.sparkSession)
        .join(g, on="observed_hour", how="left")
        .select(
            "observed_hour",
            F.coalesce("avg_delay_minutes", F.lit(0.0)).alias("avg_delay_minutes"),
            F.coalesce("observation_count", F.lit(0)).cast("bigint").alias("observation_count"),
        )
        .orderBy("observed_hour")
    )


def category_rank(col: str = "delay_category") -> F.Column:
    """L4: on time < minor < significant < severe < anything else."""
    rank = F.lit(len(S.CATEGORY_ORDER) + 1)
    expr = None
    for i, name in enumerate(S.CATEGORY_ORDER, start=1):
        expr = F.when(F.col(col) == name, i) if expr is None else expr.when(F.col(col) == name, i)
    return expr.otherwise(rank)


# A5 / L4
def delay_category_breakdown(view: DataFrame) -> DataFrame:
    g = view.groupBy(_named("delay_category", S.UNKNOWN_NAME)).agg(F.sum("observation_count").alias("observation_count"))
    return _finish_categories(g)


def _finish_categories(g: DataFrame) -> DataFrame:
    return g.orderBy(category_rank(), F.col("delay_category"))


# A6
def time_period_delay_matrix(view: DataFrame) -> DataFrame:
    g = view.groupBy(_named("route_number", ""), _named("time_period", S.UNKNOWN_NAME)).agg(
        *_minutes_aggs(), F.sum("observation_count").alias("observation_count")
    )
    return _finish_matrix(g)


def _finish_matrix(g: DataFrame) -> DataFrame:
    return _finish_minutes(g).select("route_number", "time_period", "avg_delay_minutes", "observation_count") \
        .orderBy("route_number", "time_period")


def _column_name(period: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in period.strip().lower()) or "unknown"


# rows = routes; columns = known periods in display order, then any other
# period names alphabetically; an absent cell is NULL
def time_period_pivot(matrix: DataFrame) -> DataFrame:
    """The small aggregated matrix is written once: its period names give the columns
    (as ``pivot`` itself finds values), then it is pivoted; the fact is read once."""
    matrix = dimension(matrix.withColumn("time_period", _named("time_period", S.UNKNOWN_NAME)))
    others = sorted(
        r[0] for r in matrix.select("time_period").distinct().filter(
            ~F.col("time_period").isin(*S.PERIOD_ORDER)).collect()
    )
    periods = list(S.PERIOD_ORDER) + others
    p = matrix.groupBy("route_number").pivot("time_period", periods).agg(
        F.first("avg_delay_minutes").alias("avg"), F.first("observation_count").alias("n")
    )
    out, used = [F.col("route_number")], set()
    for name in periods:
        short = plain = _column_name(name)
        while short in used:  # names that differ in punctuation only
            short = f"{plain}_{sum(u == plain or u.startswith(f'{plain}_') for u in used) + 1}"
        used.add(short)
        out.append(F.col(f"`{name}_avg`").alias(f"{short}_avg_delay_minutes"))
        out.append(F.col(f"`{name}_n`").cast("bigint").alias(f"{short}_observation_count"))
    return p.select(*out).orderBy("route_number")


def hourly_partials(view: DataFrame, by: str = "route_number") -> DataFrame:
    """Rounded hourly averages per (hour, ``by``): the kind of partial rows A12 merges."""
    return _finish_minutes(view.groupBy("observed_hour", by).agg(
        *_minutes_aggs(), F.sum("observation_count").alias("observation_count")))


# Merge partial hourly rows (count-weighted mean, clamped hour, 24 rows)
def hourly_merge(rows: DataFrame) -> DataFrame:
    """Input: (observed_hour, avg_delay_minutes, observation_count) rows, possibly
    several per hour.  The weighted sum is kept in integer hundredths so the
    mean is exact; empty input gives empty output."""
    clamped = rows.select(
        F.least(F.greatest(F.col("observed_hour").cast("int"), F.lit(0)), F.lit(23)).alias("observed_hour"),
        F.round(F.col("avg_delay_minutes") * 100).cast("bigint").alias("_cents"),
        F.greatest(F.col("observation_count").cast("bigint"), F.lit(0)).alias("_n"),
    )
    g = clamped.groupBy("observed_hour").agg(
        F.sum(F.col("_cents") * F.col("_n")).alias("_w"), F.sum("_n").alias("observation_count")
    )
    # the input is evaluated once: the merged rows (24 at most, and one without an hour) say whether there was any
    joined = hour_spine(rows.sparkSession).join(g, on="observed_hour", how="full")
    met = F.max(F.col("observation_count").isNotNull()).over(Window.partitionBy())
    merged = joined.withColumn("_any", met).where("_any AND observed_hour IS NOT NULL")
    return merged.select(
        "observed_hour",
        F.coalesce(C.rounded_mean("_w", "observation_count", divisor_seconds=100), F.lit(0.0))
        .alias("avg_delay_minutes"),
        F.coalesce("observation_count", F.lit(0)).cast("bigint").alias("observation_count"),
    ).orderBy("observed_hour")


# Value / max(value) * 100 over the whole (small, aggregated) result
def relative_bar(result: DataFrame, value: str, name: str = "bar_percent") -> DataFrame:
    top = F.max(value).over(Window.partitionBy())
    return result.withColumn(
        name,
        F.when(top > 0, F.col(value) / top * F.lit(100.0)).otherwise(F.lit(0.0)),
    )


# Conditional sums per route
def conditional_sum(view: DataFrame) -> DataFrame:
    return view.groupBy("route_number").agg(
        F.sum("delayed_count").alias("delayed_count"),
        F.sum("significant_or_severe_count").alias("significant_or_severe_count"),
        F.sum("observation_count").alias("observation_count"),
    )


# C14: the dashboard metrics by any dimensions with optional filters
def looker_metrics(
    view: DataFrame,
    by: tuple[str, ...] = ("route_number", "stop_name", "calendar_date", "observed_hour", "delay_category"),
    date_from=None,
    date_to=None,
    route_numbers: tuple[str, ...] | None = None,
    stop_names: tuple[str, ...] | None = None,
) -> DataFrame:
    v = view
    if date_from is not None:
        v = v.filter(F.col("calendar_date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        v = v.filter(F.col("calendar_date") <= F.lit(date_to).cast("date"))
    if route_numbers is not None:
        v = v.filter(F.col("route_number").isin(*route_numbers))
    if stop_names is not None:
        v = v.filter(F.col("stop_name").isin(*stop_names))
    g = v.groupBy(*by).agg(
        *_minutes_aggs(),
        F.max("delay_seconds").alias("_max_s"),
        F.sum("observation_count").alias("observation_count"),
        F.sum("delayed_count").alias("_delayed"),
    )
    return g.select(
        *by,
        C.rounded_mean("_sum_s", "_n_s").alias("avg_delay_minutes"),
        C.rounded_mean("_max_s", F.lit(1)).alias("max_delay_minutes"),
        "observation_count",
        F.try_divide(F.col("_delayed"), F.col("observation_count")).alias("delayed_share"),
    )


# The six statistics of one page; the view is read once
def load_statistics(view: DataFrame) -> dict[str, DataFrame]:
    rows = view.select(
        "calendar_date", "observed_hour", _named("stop_name", ""), C.clean_headsign("headsign").alias("headsign"),
        _named("route_number", ""), _named("delay_category", S.UNKNOWN_NAME), _named("time_period", S.UNKNOWN_NAME),
        F.col("delay_seconds").alias("_sum_s"), F.when(F.col("delay_seconds").isNotNull(), 1).otherwise(0).alias("_n_s"),
        F.col("delay_seconds").alias("_max_s"), "observation_count", F.col("delayed_count").alias("_delayed"),
        "significant_or_severe_count",
    )
    groupings = ((), ("stop_name", "headsign"), ("calendar_date", "route_number"), ("observed_hour",), ("delay_category",),
                 ("route_number", "time_period"))
    parts = one_pass(rows, groupings, ("_sum_s", "_n_s", "observation_count", "_delayed", "significant_or_severe_count"), ("_max_s",))
    total = parts.part().agg(  # one row also where the view is empty
        F.max("_sum_s").alias("_sum_s"), F.coalesce(F.max("_n_s"), F.lit(0)).alias("_n_s"), F.max("_max_s").alias("_max_s"),
        F.max("observation_count").alias("_obs"), F.max("_delayed").alias("_delayed"), F.max("significant_or_severe_count").alias("_sig"))
    return {
        "kpi_summary": _finish_kpi(total),
        "stop_delay_ranking": _finish_ranking(parts.part("stop_name", "headsign"), S.RANKING_LIMIT),
        "daily_delay_trend": _finish_daily(parts.part("calendar_date", "route_number")),
        "hourly_delay_trend": _finish_hourly(parts.part("observed_hour")),
        "delay_category_breakdown": _finish_categories(parts.part("delay_category").select("delay_category", "observation_count")),
        "time_period_delay_matrix": _finish_matrix(parts.part("route_number", "time_period")),
    }


# C8 as one table
def page_statistics(view: DataFrame) -> DataFrame:
    return stacked(load_statistics(view))


# F28/F29 page KPI line of a view
def kpi_display(view: DataFrame) -> DataFrame:
    counts = view.agg(F.sum("delayed_count").alias("_delayed"), F.sum("observation_count").alias("_obs"),
                      C.rounded_mean(F.sum("delay_seconds"), F.count("delay_seconds")).alias("_avg"))
    average = F.coalesce("_avg", F.lit(0.0))
    return counts.select(
        average.alias("avg_delay_minutes"),
        C.kpi_target_flag(average).alias("target_flag"),
        C.minutes_text(average).alias("avg_delay_text"),
        F.coalesce(C.percent_text("_delayed", "_obs"), F.lit("0.0%")).alias("delayed_text"),
    )


# Latest observations with stop and route names, page-formatted
def recent_history(observations: DataFrame, stops: DataFrame, routes: DataFrame,
                   limit: int = S.HISTORY_LIMIT, zone: str = S.LOCAL_ZONE) -> DataFrame:
    """Top-``limit`` by creation time (missing times last, id breaks ties); the
    inner joins are against the small stop/route tables, the limit is a
    per-partition top-k merged once (no global sort)."""
    top = history_join(observations, stops, routes).orderBy(
        F.col("created_at").desc_nulls_last(), F.col("observation_id").asc()).limit(limit)
    return history_format(top, zone)


# C10 / L2 on a stored history: the newest days first, and no day that cannot be on the page
def latest_history(tables: TableSet, table: str, stops: DataFrame, routes: DataFrame,
                   limit: int = S.HISTORY_LIMIT, zone: str = S.LOCAL_ZONE) -> DataFrame:
    named = lambda rows: history_join(rows, stops, routes)
    return history_format(newest_rows(tables, table, "created_at", limit, named, ties=("observation_id",)), zone)


# Observations with their stop and route names (inner joins on the ids)
def history_join(observations: DataFrame, stops: DataFrame, routes: DataFrame) -> DataFrame:
    s = stops.select(F.col("id").alias("stop_id"), F.col("name").alias("_station"))
    r = routes.select(F.col("id").alias("route_id"), F.col("short_name").alias("_route"))
    return observations.join(s, "stop_id", "inner").join(r, "route_id", "inner")


# page texts of history rows
def history_format(joined: DataFrame, zone: str = S.LOCAL_ZONE) -> DataFrame:
    return joined.select(
        "observation_id",
        C.history_text("_station").alias("station_name"),
        C.history_text("_route").alias("route_short_name"),
        C.history_text("headsign").alias("destination_name"),
        C.local_clock("scheduled_departure", zone).alias("expected_departure"),
        C.local_clock("predicted_departure", zone).alias("realtime_departure"),
        F.coalesce(F.col("delay_seconds"), F.lit(0)).cast("string").alias("delay_seconds"),
    )


# C8 gate: does the page have anything to show?
def statistics_gate(view: DataFrame, snapshot: DataFrame) -> DataFrame:
    """One row: ``has_dashboard_statistics`` and ``has_legacy_statistics``.

    Every list of the page is non-empty when the view has a row, and the hourly list
    always has its 24 hours; the snapshot lists are non-empty when the snapshot has a
    row.  So one EXISTS per input answers both, without computing any statistic.
    """
    spark = view.sparkSession
    dashboard = view.exists() | hour_spine(spark).exists()
    return spark.range(1).select(dashboard.alias("has_dashboard_statistics"),
                                 snapshot.exists().alias("has_legacy_statistics"))
