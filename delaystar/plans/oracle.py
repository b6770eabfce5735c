"""DuckDB twins of the registered queries (independent SQL on the parquet views).

Every twin starts from the same ``WITH`` prefix that derives the operational
tables from ``lineitem``; the rest is written against those CTEs, not copied
from the Spark plan.  Local time is ``ts AT TIME ZONE 'UTC' AT TIME ZONE zone``.
Averages are rounded in integers exactly like the Spark side
(``(200*|sum| + 60*n) // (120*n) / 100`` with the sign restored).
"""

from __future__ import annotations

import re

from delaystar import schemas

LOCAL = "((({ts}) AT TIME ZONE 'UTC') AT TIME ZONE '{zone}')"


def local(ts: str, zone: str = "Europe/Budapest") -> str:
    return LOCAL.format(ts=ts, zone=zone)


def fact_sql(source: str, zone: str = "Europe/Budapest") -> str:
    """Body of the fact build over an observation CTE, local clock in ``zone``."""
    return f"""
  SELECT o.observation_id AS source_observation_id,
         CAST(year(lt) * 10000 + month(lt) * 100 + day(lt) AS BIGINT) AS date_key,
         r.route_key, s.stop_key, o.collection_run_id, o.trip_id, o.headsign, o.direction_id,
         CAST(o.stop_sequence AS BIGINT) AS stop_sequence, o.created_at AS observed_at,
         o.scheduled_departure, o.predicted_departure,
         CAST(o.delay_seconds AS BIGINT) AS delay_seconds,
         CAST(o.delay_seconds AS DOUBLE) / 60.0 AS delay_minutes,
         CASE WHEN o.delay_seconds <= 60 THEN 'on time' WHEN o.delay_seconds <= 180 THEN 'minor delay'
              WHEN o.delay_seconds <= 300 THEN 'significant delay' ELSE 'severe delay' END AS delay_category,
         o.delay_category AS source_delay_category,
         CASE WHEN hour(lt) BETWEEN 6 AND 9 THEN 'morning peak'
              WHEN hour(lt) BETWEEN 15 AND 18 THEN 'afternoon peak' ELSE 'other period' END AS time_period,
         CAST(1 AS BIGINT) AS observation_count
  FROM (SELECT *, {local('created_at', zone)} AS lt FROM {source}
        WHERE created_at IS NOT NULL AND delay_seconds IS NOT NULL AND delay_seconds >= 0) AS o
  JOIN dim_route AS r ON r.source_route_id = o.route_id
  JOIN dim_stop AS s ON s.source_stop_id = o.stop_id"""


def dim_date_sql(source: str) -> str:
    return f"""
  SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS calendar_date,
         CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
         monthname(d) AS month_name, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week_number,
         CASE WHEN dayofweek(d) IN (0, 6) THEN 'weekend' ELSE 'weekday' END AS day_type
  FROM (SELECT CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS d
        FROM (SELECT CAST({local('min(created_at)')} AS DATE) AS start_date,
                     CAST({local('max(created_at)')} AS DATE) AS end_date FROM {source}) AS b
        WHERE start_date IS NOT NULL) AS days"""


def rmean(s: str, n: str, d: int = 60) -> str:
    """Signed half-up rounded mean of integer ``s`` over ``n`` in units of ``d``."""
    return (
        f"(CASE WHEN ({n}) > 0 THEN (CASE WHEN ({s}) < 0 THEN -1 ELSE 1 END) * "
        f"((200 * abs({s}) + {d} * ({n})) // ({2 * d} * ({n}))) / 100.0 END)"
    )


FIXTURE = """
raw_obs AS (
  SELECT concat('O_', l_orderkey, '_', l_linenumber) AS observation_id,
         concat('RUN_', l_orderkey % 360) AS collection_run_id,
         CASE WHEN l_suppkey % 97 = 0 THEN 'R_9999'
              ELSE CASE l_orderkey % 5 WHEN 0 THEN 'R_3040' WHEN 1 THEN 'R_3060' WHEN 2 THEN 'R_0070'
                   WHEN 3 THEN 'R_1050' ELSE 'R_5100' END END AS route_id,
         concat('S_', (l_orderkey + l_linenumber * 3) % 20) AS stop_id,
         concat('T_', l_orderkey) AS trip_id,
         CASE l_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'Újbuda-központ M'
              WHEN 3 THEN 'Móricz Zsigmond körtér M' WHEN 4 THEN 'Széll Kálmán tér M' ELSE 'Mexikói út M' END AS headsign,
         CASE WHEN l_orderkey % 50 = 0 THEN '' ELSE concat('', l_linenumber % 2) END AS direction_id,
         l_linenumber AS stop_sequence,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(off) AS scheduled_departure,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(off + coalesce(ds, 0)) AS predicted_departure,
         CASE WHEN l_orderkey % 199 = 0 THEN NULL
              ELSE TIMESTAMP '2024-01-01 00:00:00' + to_seconds(off + l_partkey % 3600 - 1800) END AS created_at,
         ds AS delay_seconds,
         CASE WHEN ds < -60 THEN 'early' WHEN ds <= 60 THEN 'on_time' WHEN ds <= 180 THEN 'minor_delay'
              WHEN ds <= 360 THEN 'medium_delay' WHEN ds > 360 THEN 'major_delay' END AS delay_category,
         concat('T_', l_orderkey, '|S_', (l_orderkey + l_linenumber * 3) % 20, '|',
                strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(off), '%Y-%m-%dT%H:%M:%S'), '+00:00') AS duplicate_key,
         l_partkey AS tie_1, l_suppkey AS tie_2, l_quantity AS tie_3, l_extendedprice AS tie_4
  FROM (SELECT *, (l_orderkey % 360) * 86400 + (l_orderkey * 7919) % 86400 AS off,
               CASE WHEN l_orderkey % 211 = 0 THEN NULL
                    ELSE CAST(l_quantity AS BIGINT) * 12 - 120 + l_linenumber END AS ds
        FROM lineitem) AS l
),
routes AS (
  SELECT * FROM (VALUES ('R_3040', '4', 'TRAM'), ('R_3060', '6', 'TRAM'), ('R_0070', '7', 'BUS'),
                        ('R_1050', '105', 'BUS'), ('R_5100', 'M1', 'SUBWAY')) AS t(id, short_name, route_type)
  UNION ALL
  SELECT concat('R_S', s_suppkey), concat('S', s_suppkey),
         CASE s_nationkey % 3 WHEN 0 THEN 'BUS' WHEN 1 THEN 'TRAM' ELSE 'TROLLEY' END
  FROM supplier
),
stops AS (
  SELECT concat('S_', i) AS id, concat('Stop ', i // 2) AS name,
         CASE WHEN i = 19 THEN NULL ELSE 47.4 + i / 1000.0 END::DOUBLE AS lat,
         CASE WHEN i = 19 THEN NULL ELSE 19.0 + i / 1000.0 END::DOUBLE AS lon
  FROM range(20) AS r(i)
  UNION ALL
  SELECT concat('S_P', p_partkey), p_name,
         CASE WHEN p_partkey % 50 <> 0 THEN 47.0::DOUBLE + (p_partkey % 1000)::DOUBLE / 1000.0::DOUBLE END,
         CASE WHEN p_partkey % 50 <> 0 THEN 19.0::DOUBLE + (p_partkey % 777)::DOUBLE / 1000.0::DOUBLE END
  FROM part
),
obs AS (
  SELECT * FROM raw_obs
  QUALIFY row_number() OVER (PARTITION BY duplicate_key
                             ORDER BY created_at ASC NULLS LAST, tie_1, tie_2, tie_3, tie_4) = 1
),
dim_route AS (
  SELECT id AS route_key, id AS source_route_id, short_name AS route_number,
         route_type || ' line ' || short_name AS route_name, route_type
  FROM routes
),
dim_stop AS (
  SELECT id AS stop_key, id AS source_stop_id, name AS stop_name, lat, lon FROM stops
),
dim_date AS (@DIMDATE@
),
fact AS (@FACT@
),
v AS (
  SELECT d.calendar_date, d.year, d.month, d.month_name, d.day_of_week_number, d.day_type,
         r.route_number, r.route_name, r.route_type, s.stop_name, s.lat, s.lon,
         f.collection_run_id, f.trip_id, f.headsign, f.direction_id, f.stop_sequence, f.observed_at,
         @LOBSERVED@ AS observed_at_budapest,
         CAST(hour(@LOBSERVED@) AS INTEGER) AS observed_hour,
         f.scheduled_departure, f.predicted_departure, f.delay_seconds, f.delay_minutes,
         f.delay_category, f.source_delay_category, f.time_period, f.observation_count,
         CAST(CASE WHEN f.delay_seconds > 60 THEN 1 ELSE 0 END AS BIGINT) AS delayed_count,
         CAST(CASE WHEN f.delay_category IN ('significant delay', 'severe delay') THEN 1 ELSE 0 END AS BIGINT)
           AS significant_or_severe_count
  FROM fact AS f
  JOIN dim_date AS d ON d.date_key = f.date_key
  JOIN dim_route AS r ON r.route_key = f.route_key
  JOIN dim_stop AS s ON s.stop_key = f.stop_key
  WHERE r.route_number IN ('4', '6')
)
"""
for _ph, _expr in {
    "@DIMDATE@": dim_date_sql("obs"),
    "@FACT@": fact_sql("obs"),
    "@LOBSERVED@": local("f.observed_at"),
}.items():
    FIXTURE = FIXTURE.replace(_ph, _expr)


def with_prefix(body: str, extra_ctes: str = "") -> str:
    ctes = FIXTURE.strip()
    if extra_ctes:
        ctes = ctes + ",\n" + extra_ctes.strip()
    return "WITH " + ctes + "\n" + body.strip()


SQL: dict[str, str] = {}
BODIES: dict[str, str] = {}


def register(name: str, body: str, extra_ctes: str = "") -> None:
    BODIES[name] = body.strip()
    SQL[name] = with_prefix(body, extra_ctes)


def stacked(parts: dict[str, str]) -> str:
    """Registered queries below each other: ``part`` names them, columns that a part lacks are null."""
    return " UNION ALL BY NAME ".join(f"SELECT '{part}' AS part, p.* FROM ({BODIES[name]}) AS p" for part, name in parts.items())


# ---------------------------------------------------------------- warehouse
register("build_dim_date", "SELECT * FROM dim_date")
register("build_dim_route", "SELECT * FROM dim_route")
register("build_dim_stop", "SELECT * FROM dim_stop")
register("build_fact", "SELECT * FROM fact")
register("dashboard_view", "SELECT * FROM v")

# ---------------------------------------------------------------- statistics
register(
    "kpi_summary",
    f"""
SELECT coalesce({rmean('sum(delay_seconds)', 'count(delay_seconds)')}, 0.0) AS avg_delay_minutes,
       coalesce({rmean('max(delay_seconds)', '1')}, 0.0) AS max_delay_minutes,
       CAST(coalesce(sum(observation_count), 0) AS BIGINT) AS observation_count,
       coalesce(CAST(sum(delayed_count) AS DOUBLE) / nullif(sum(observation_count), 0), 0.0) AS delayed_ratio,
       CAST(coalesce(sum(significant_or_severe_count), 0) AS BIGINT) AS significant_or_severe_count
FROM v""",
)

MIN = rmean("sum(delay_seconds)", "count(delay_seconds)")

RANKING = f"""
SELECT stop_name, headsign, {rmean('s', 'n')} AS avg_delay_minutes,
       significant_or_severe_count, observation_count
FROM (SELECT stop_name, coalesce(nullif(headsign, ''), 'unknown') AS headsign,
             sum(delay_seconds) AS s, count(delay_seconds) AS n,
             CAST(sum(significant_or_severe_count) AS BIGINT) AS significant_or_severe_count,
             CAST(sum(observation_count) AS BIGINT) AS observation_count
      FROM v GROUP BY 1, 2) AS g
ORDER BY avg_delay_minutes DESC, significant_or_severe_count DESC, stop_name, headsign
LIMIT 15"""
register("stop_delay_ranking", RANKING)

register(
    "daily_delay_trend",
    f"""
SELECT calendar_date, route_number, {MIN} AS avg_delay_minutes,
       CAST(sum(observation_count) AS BIGINT) AS observation_count
FROM v GROUP BY calendar_date, route_number ORDER BY calendar_date, route_number""",
)

HOURLY = f"""
SELECT CAST(h.i AS INTEGER) AS observed_hour,
       coalesce(a.avg_delay_minutes, 0.0) AS avg_delay_minutes,
       CAST(coalesce(a.observation_count, 0) AS BIGINT) AS observation_count
FROM range(24) AS h(i)
LEFT JOIN (SELECT observed_hour, {MIN} AS avg_delay_minutes, sum(observation_count) AS observation_count
           FROM v GROUP BY observed_hour) AS a ON a.observed_hour = h.i
ORDER BY observed_hour"""
register("hourly_delay_trend", HOURLY)

register(
    "delay_category_breakdown",
    """
SELECT delay_category, CAST(sum(observation_count) AS BIGINT) AS observation_count
FROM v GROUP BY delay_category
ORDER BY CASE delay_category WHEN 'on time' THEN 1 WHEN 'minor delay' THEN 2
         WHEN 'significant delay' THEN 3 WHEN 'severe delay' THEN 4 ELSE 5 END, delay_category""",
)

MATRIX = f"""
SELECT route_number, time_period, {MIN} AS avg_delay_minutes,
       CAST(sum(observation_count) AS BIGINT) AS observation_count
FROM v GROUP BY route_number, time_period"""
register("time_period_delay_matrix", MATRIX + " ORDER BY route_number, time_period")

register(
    "time_period_pivot",
    """
SELECT route_number,
       max(CASE WHEN time_period = 'morning peak' THEN avg_delay_minutes END) AS morning_peak_avg_delay_minutes,
       CAST(max(CASE WHEN time_period = 'morning peak' THEN observation_count END) AS BIGINT)
         AS morning_peak_observation_count,
       max(CASE WHEN time_period = 'afternoon peak' THEN avg_delay_minutes END) AS afternoon_peak_avg_delay_minutes,
       CAST(max(CASE WHEN time_period = 'afternoon peak' THEN observation_count END) AS BIGINT)
         AS afternoon_peak_observation_count,
       max(CASE WHEN time_period = 'other period' THEN avg_delay_minutes END) AS other_period_avg_delay_minutes,
       CAST(max(CASE WHEN time_period = 'other period' THEN observation_count END) AS BIGINT)
         AS other_period_observation_count
FROM m GROUP BY route_number ORDER BY route_number""",
    extra_ctes=f"m AS ({MATRIX})",
)

register(
    "hourly_merge",
    f"""
SELECT CAST(h.i AS INTEGER) AS observed_hour,
       coalesce({rmean('g.w', 'g.n', 100)}, 0.0) AS avg_delay_minutes,
       CAST(coalesce(g.n, 0) AS BIGINT) AS observation_count
FROM range(24) AS h(i)
LEFT JOIN (SELECT least(greatest(observed_hour, 0), 23) AS hr,
                  sum(CAST(round(avg_delay_minutes * 100) AS BIGINT) * greatest(observation_count, 0)) AS w,
                  sum(greatest(observation_count, 0)) AS n
           FROM parts GROUP BY 1) AS g ON g.hr = h.i
WHERE EXISTS (SELECT 1 FROM parts)
ORDER BY observed_hour""",
    extra_ctes=f"""parts AS (
  SELECT observed_hour, route_number, {MIN} AS avg_delay_minutes,
         CAST(sum(observation_count) AS BIGINT) AS observation_count
  FROM v GROUP BY observed_hour, route_number)""",
)

register(
    "relative_bar",
    """
SELECT d.*, CASE WHEN m.top > 0 THEN d.avg_delay_minutes / m.top * 100.0 ELSE 0.0 END AS bar_percent
FROM daily AS d, (SELECT max(avg_delay_minutes) AS top FROM daily) AS m""",
    extra_ctes=f"""daily AS (
  SELECT calendar_date, route_number, {MIN} AS avg_delay_minutes,
         CAST(sum(observation_count) AS BIGINT) AS observation_count
  FROM v GROUP BY calendar_date, route_number)""",
)

register(
    "conditional_sum",
    """
SELECT route_number, CAST(sum(delayed_count) AS BIGINT) AS delayed_count,
       CAST(sum(significant_or_severe_count) AS BIGINT) AS significant_or_severe_count,
       CAST(sum(observation_count) AS BIGINT) AS observation_count
FROM v GROUP BY route_number""",
)

register(
    "looker_metrics",
    f"""
SELECT route_number, stop_name, calendar_date, observed_hour, delay_category,
       {MIN} AS avg_delay_minutes, {rmean('max(delay_seconds)', '1')} AS max_delay_minutes,
       CAST(sum(observation_count) AS BIGINT) AS observation_count,
       CAST(sum(delayed_count) AS DOUBLE) / nullif(sum(observation_count), 0) AS delayed_share
FROM v GROUP BY route_number, stop_name, calendar_date, observed_hour, delay_category""",
)

# ---------------------------------------------------------------- source audit
register(
    "table_row_counts",
    """
SELECT 'collection_runs' AS table_name, CAST(count(DISTINCT collection_run_id) AS BIGINT) AS row_count FROM obs
UNION ALL SELECT 'delay_observations', CAST(count(*) AS BIGINT) FROM obs
UNION ALL SELECT 'routes', CAST(count(*) AS BIGINT) FROM routes
UNION ALL SELECT 'stops', CAST(count(*) AS BIGINT) FROM stops
ORDER BY table_name""",
)

register(
    "source_distribution",
    f"""
SELECT CAST(count(*) AS BIGINT) AS observations, min(created_at) AS first_observed_at,
       max(created_at) AS last_observed_at, CAST(min(delay_seconds) AS BIGINT) AS min_delay_seconds,
       CAST(max(delay_seconds) AS BIGINT) AS max_delay_seconds,
       {rmean('sum(delay_seconds)', 'count(delay_seconds)', 1)} AS avg_delay_seconds
FROM obs""",
)

register(
    "mandatory_field_audit",
    """
SELECT CAST(count(*) FILTER (WHERE observation_id IS NULL) AS BIGINT) AS missing_id,
       CAST(count(*) FILTER (WHERE route_id IS NULL OR route_id = '') AS BIGINT) AS missing_route_id,
       CAST(count(*) FILTER (WHERE stop_id IS NULL OR stop_id = '') AS BIGINT) AS missing_stop_id,
       CAST(count(*) FILTER (WHERE direction_id IS NULL OR direction_id = '') AS BIGINT) AS missing_direction_id,
       CAST(count(*) FILTER (WHERE created_at IS NULL) AS BIGINT) AS missing_created_at,
       CAST(count(*) FILTER (WHERE scheduled_departure IS NULL) AS BIGINT) AS missing_scheduled_departure,
       CAST(count(*) FILTER (WHERE predicted_departure IS NULL) AS BIGINT) AS missing_predicted_departure,
       CAST(count(*) FILTER (WHERE delay_seconds IS NULL) AS BIGINT) AS missing_delay_seconds,
       CAST(count(*) FILTER (WHERE delay_seconds < 0) AS BIGINT) AS negative_delay_seconds
FROM obs""",
)

register(
    "join_coverage",
    """
SELECT CAST(count(*) FILTER (WHERE r.id IS NULL) AS BIGINT) AS observations_without_route,
       CAST(count(*) FILTER (WHERE s.id IS NULL) AS BIGINT) AS observations_without_stop
FROM obs AS o LEFT JOIN routes AS r ON r.id = o.route_id LEFT JOIN stops AS s ON s.id = o.stop_id""",
)

register(
    "audit_preview",
    """
SELECT observation_id, route_id, stop_id, direction_id, headsign, stop_sequence, created_at AS observed_at,
       scheduled_departure, predicted_departure, delay_seconds, delay_category
FROM obs ORDER BY created_at DESC NULLS LAST, observation_id LIMIT 20""",
)

# ---------------------------------------------------------------- warehouse checks
RECONCILE = """
SELECT (SELECT CAST(count(*) AS BIGINT) FROM obs
        WHERE created_at IS NOT NULL AND delay_seconds IS NOT NULL AND delay_seconds >= 0) AS usable_raw_rows,
       (SELECT CAST(count(*) AS BIGINT) FROM fact) AS fact_rows"""
register("reconcile_counts", RECONCILE)

DUPES = """
SELECT 'duplicate_fact_ids' AS issue, CAST(count(*) AS BIGINT) AS issue_count
FROM (SELECT source_observation_id FROM {fact} GROUP BY 1 HAVING count(*) > 1) AS a
UNION ALL SELECT 'duplicate_route_keys', CAST(count(*) AS BIGINT)
FROM (SELECT route_key FROM dim_route GROUP BY 1 HAVING count(*) > 1) AS b
UNION ALL SELECT 'duplicate_stop_keys', CAST(count(*) AS BIGINT)
FROM (SELECT stop_key FROM dim_stop GROUP BY 1 HAVING count(*) > 1) AS c
UNION ALL SELECT 'duplicate_date_keys', CAST(count(*) AS BIGINT)
FROM (SELECT date_key FROM {dim_date} GROUP BY 1 HAVING count(*) > 1) AS d"""
register(
    "duplicate_key_report",
    DUPES.format(fact="fact_all", dim_date="dim_date_all"),
    extra_ctes=f"fact_all AS ({fact_sql('raw_obs')}),\ndim_date_all AS ({dim_date_sql('raw_obs')})",
)

ISSUES = f"""
SELECT CAST(count(*) FILTER (WHERE f.source_observation_id IS NULL) AS BIGINT) AS missing_observation_id,
       CAST(count(*) FILTER (WHERE d.date_key IS NULL) AS BIGINT) AS unresolved_date,
       CAST(count(*) FILTER (WHERE r.route_key IS NULL) AS BIGINT) AS unresolved_route,
       CAST(count(*) FILTER (WHERE s.stop_key IS NULL) AS BIGINT) AS unresolved_stop,
       CAST(count(*) FILTER (WHERE f.delay_seconds IS NULL OR f.delay_seconds < 0) AS BIGINT) AS invalid_delay,
       CAST(count(*) FILTER (WHERE f.observed_at IS NULL) AS BIGINT) AS missing_observed_at,
       CAST(count(*) FILTER (WHERE f.date_key != CAST(strftime(CAST({local('f.observed_at')} AS DATE), '%Y%m%d') AS BIGINT))
            AS BIGINT) AS local_date_mismatch,
       CAST(count(*) FILTER (WHERE f.time_period IS NULL OR f.time_period != CASE
            WHEN hour({local('f.observed_at')}) BETWEEN 6 AND 9 THEN 'morning peak'
            WHEN hour({local('f.observed_at')}) BETWEEN 15 AND 18 THEN 'afternoon peak'
            ELSE 'other period' END) AS BIGINT) AS local_time_period_mismatch
FROM {{fact}} AS f
LEFT JOIN dim_date AS d ON d.date_key = f.date_key
LEFT JOIN dim_route AS r ON r.route_key = f.route_key
LEFT JOIN dim_stop AS s ON s.stop_key = f.stop_key"""
register("warehouse_issue_row", ISSUES.format(fact="fact"))
register(
    "warehouse_issue_row_utc_build",
    ISSUES.format(fact="fact_utc"),
    extra_ctes=f"fact_utc AS ({fact_sql('obs', 'UTC')})",
)

# ---------------------------------------------------------------- snapshot statistics
F9_DIGITS = "regexp_replace(trim(route_id), '[^0-9]', '', 'g')"
F9 = (
    f"(CASE WHEN {F9_DIGITS} IN ('3040', '4') OR suffix({F9_DIGITS}, '3040') THEN '4' "
    f"WHEN {F9_DIGITS} IN ('3060', '6') OR suffix({F9_DIGITS}, '3060') THEN '6' "
    "ELSE regexp_extract(trim(route_id), '(?:^|[^0-9])([46])$', 1) END)"
)
F8_NAME = "replace(lower(trim(delay_category)), '_', ' ')"
F8 = (
    f"(CASE WHEN {F8_NAME} IN ('on time', 'minor delay', 'significant delay', 'severe delay') THEN {F8_NAME} "
    f"WHEN {F8_NAME} = 'major delay' THEN 'significant delay' "
    "WHEN delay_seconds <= 60 THEN 'on time' WHEN delay_seconds <= 180 THEN 'minor delay' "
    "WHEN delay_seconds <= 300 THEN 'significant delay' ELSE 'severe delay' END)"
)
F10 = (
    "(CASE WHEN trim(coalesce(o.headsign, '')) = '' THEN 'unknown' "
    "WHEN lower(strip_accents(trim(o.headsign))) IN ('ujbuda-kozpont m', 'moricz zsigmond korter m') "
    "THEN 'Újbuda-központ M / Móricz Zsigmond körtér M' ELSE trim(o.headsign) END)"
)


def period_of(hour_expr: str) -> str:
    return (f"(CASE WHEN {hour_expr} BETWEEN 6 AND 9 THEN 'morning peak' "
            f"WHEN {hour_expr} BETWEEN 15 AND 18 THEN 'afternoon peak' ELSE 'other period' END)")


SNAP = f"""snap AS (
  SELECT o.stop_id, coalesce(s.name, o.stop_id) AS stop_name, {F10} AS headsign, o.rn AS route_number,
         CAST(o.delay_seconds AS BIGINT) AS delay_seconds, o.delay_seconds > 60 AS is_delayed,
         o.dc AS display_category, o.dc IN ('significant delay', 'severe delay') AS is_sig,
         CAST(o.created_at AS DATE) AS created_date,
         CAST(hour({local('o.created_at')}) AS INTEGER) AS observed_hour,
         {period_of(f"hour({local('o.scheduled_departure')})")} AS time_period,
         date_trunc('hour', o.scheduled_departure) AS period_start
  FROM (SELECT *, {F9} AS rn, {F8} AS dc FROM raw_obs
        WHERE created_at IS NOT NULL AND delay_seconds IS NOT NULL) AS o
  LEFT JOIN stops AS s ON s.id = o.stop_id
  WHERE o.rn IN ('4', '6')
),
stop_groups AS (
  SELECT stop_id, stop_name, headsign, sum(delay_seconds) AS s, CAST(count(*) AS BIGINT) AS observation_count,
         CAST(count_if(is_delayed) AS BIGINT) AS delayed, CAST(count_if(is_sig) AS BIGINT) AS sig
  FROM snap GROUP BY stop_id, stop_name, headsign
)"""

SNAP_MIN = rmean("sum(delay_seconds)", "count(*)")

register(
    "snap_kpi",
    f"""
SELECT {SNAP_MIN} AS avg_delay_minutes, {rmean('max(delay_seconds)', '1')} AS max_delay_minutes,
       CAST(count(*) AS BIGINT) AS observation_count,
       CAST(count_if(is_delayed) AS DOUBLE) / count(*) AS delayed_ratio,
       CAST(count_if(is_sig) AS BIGINT) AS significant_or_severe_count
FROM snap HAVING count(*) > 0""",
    extra_ctes=SNAP,
)
register(
    "snap_stop_ranking",
    f"""
SELECT stop_name, headsign, avg_delay_minutes, significant_or_severe_count, observation_count
FROM (SELECT stop_id, stop_name, headsign, {rmean('s', 'observation_count')} AS avg_delay_minutes,
             sig AS significant_or_severe_count, observation_count FROM stop_groups) AS g
ORDER BY avg_delay_minutes DESC, significant_or_severe_count DESC, stop_id, stop_name, headsign
LIMIT 10""",
    extra_ctes=SNAP,
)
register(
    "snap_daily_trend",
    f"""
SELECT created_date AS calendar_date, route_number, {SNAP_MIN} AS avg_delay_minutes,
       CAST(count(*) AS BIGINT) AS observation_count
FROM snap GROUP BY created_date, route_number ORDER BY 1, 2""",
    extra_ctes=SNAP,
)
register(
    "snap_hourly_trend",
    f"""
SELECT CAST(h.i AS INTEGER) AS observed_hour, coalesce(a.avg_delay_minutes, 0.0) AS avg_delay_minutes,
       CAST(coalesce(a.observation_count, 0) AS BIGINT) AS observation_count
FROM range(24) AS h(i)
LEFT JOIN (SELECT observed_hour, {SNAP_MIN} AS avg_delay_minutes, count(*) AS observation_count
           FROM snap GROUP BY observed_hour) AS a ON a.observed_hour = h.i
WHERE EXISTS (SELECT 1 FROM snap)
ORDER BY 1""",
    extra_ctes=SNAP,
)
register(
    "snap_category_breakdown",
    """
SELECT display_category AS delay_category, CAST(count(*) AS BIGINT) AS observation_count
FROM snap GROUP BY display_category""",
    extra_ctes=SNAP,
)
register(
    "snap_time_period_matrix",
    f"""
SELECT route_number, time_period, {SNAP_MIN} AS avg_delay_minutes, CAST(count(*) AS BIGINT) AS observation_count
FROM snap GROUP BY route_number, time_period""",
    extra_ctes=SNAP,
)
register(
    "average_delay_by_stop",
    """
SELECT stop_id, stop_name, headsign, observation_count, s / observation_count AS average_delay_seconds
FROM stop_groups""",
    extra_ctes=SNAP,
)
register(
    "delayed_ratio_by_period",
    """
SELECT period_start, CAST(count(*) AS BIGINT) AS observation_count, CAST(count_if(is_delayed) AS BIGINT) AS delayed_count,
       count_if(is_delayed) / count(*) AS delayed_ratio, sum(delay_seconds) / count(*) AS average_delay_seconds
FROM snap GROUP BY period_start""",
    extra_ctes=SNAP,
)
register(
    "most_problematic_stops",
    """
SELECT stop_id, stop_name, headsign, observation_count, s / observation_count AS average_delay_seconds,
       delayed / observation_count AS delayed_ratio, sig AS major_delay_count
FROM stop_groups""",
    extra_ctes=SNAP,
)

# ---------------------------------------------------------------- dedup, sinks, merge
register("dedup_first_by_key", "SELECT * FROM obs")
register(
    "dedup_latest_by_id",
    """
SELECT * FROM raw_obs
QUALIFY row_number() OVER (PARTITION BY observation_id
                           ORDER BY created_at DESC NULLS LAST, tie_1 DESC, tie_2 DESC, tie_3 DESC, tie_4 DESC) = 1""",
)

MERGE = f"""tgt AS (
  SELECT * FROM obs WHERE created_at < TIMESTAMP '2024-06-29 00:00:00'
),
bat AS (
  SELECT * REPLACE (delay_seconds + 5 AS delay_seconds) FROM raw_obs
  WHERE created_at >= TIMESTAMP '2024-06-28 00:00:00' AND created_at <= TIMESTAMP '2024-06-30 00:00:00'
),
bat_latest AS (
  SELECT * FROM bat
  QUALIFY row_number() OVER (PARTITION BY observation_id
                             ORDER BY created_at DESC NULLS LAST, tie_1 DESC, tie_2 DESC, tie_3 DESC, tie_4 DESC) = 1
),
raw_merged AS (
  SELECT * EXCLUDE (src) FROM (SELECT *, 0 AS src FROM tgt UNION ALL SELECT *, 1 AS src FROM bat_latest) AS u
  QUALIFY row_number() OVER (PARTITION BY observation_id ORDER BY src DESC) = 1
),
dim_date_tgt AS ({dim_date_sql('tgt')}
),
fact_tgt AS ({fact_sql('tgt')}
),
fact_bat AS ({fact_sql('bat_latest')}
),
fact_merged AS (
  SELECT * EXCLUDE (src) FROM (SELECT *, 0 AS src FROM fact_tgt UNION ALL SELECT *, 1 AS src FROM fact_bat) AS u
  QUALIFY row_number() OVER (PARTITION BY source_observation_id ORDER BY src DESC) = 1
)"""

INSERTS = """bat_flags AS (
  SELECT b.*, (b.first_in_batch AND t.duplicate_key IS NULL) AS inserted
  FROM (SELECT *, row_number() OVER (PARTITION BY duplicate_key
                  ORDER BY created_at ASC NULLS LAST, tie_1, tie_2, tie_3, tie_4) = 1 AS first_in_batch
        FROM raw_obs) AS b
  LEFT JOIN (SELECT DISTINCT duplicate_key FROM obs WHERE created_at < TIMESTAMP '2024-05-01 00:00:00') AS t
    ON t.duplicate_key = b.duplicate_key
)"""

register(
    "insert_ignore",
    "SELECT * EXCLUDE (first_in_batch, inserted) FROM bat_flags WHERE inserted",
    extra_ctes=INSERTS,
)
register(
    "save_summary",
    """
SELECT collection_run_id, CAST(count(DISTINCT route_id) AS BIGINT) AS routes_saved,
       CAST(count(DISTINCT stop_id) AS BIGINT) AS stops_saved, CAST(1 AS BIGINT) AS collection_runs_saved,
       CAST(count_if(inserted) AS BIGINT) AS delay_observations_saved,
       CAST(count_if(NOT inserted) AS BIGINT) AS duplicate_observations_skipped,
       CAST(count(DISTINCT route_id) + count(DISTINCT stop_id) + 1 + count_if(inserted) AS BIGINT) AS total_saved
FROM bat_flags GROUP BY collection_run_id""",
    extra_ctes=INSERTS,
)
register(
    "run_records_saved",
    """
SELECT r.id, r.started_at, r.finished_at, 'success' AS status,
       CAST(coalesce(a.n, 0) AS INTEGER) AS records_saved, '' AS error_message
FROM (SELECT collection_run_id AS id, min(created_at) AS started_at, max(created_at) AS finished_at
      FROM raw_obs GROUP BY collection_run_id) AS r
LEFT JOIN (SELECT collection_run_id, count(*) AS n FROM bat_flags WHERE inserted GROUP BY 1) AS a
  ON a.collection_run_id = r.id""",
    extra_ctes=INSERTS,
)
register(
    "overlap_extract",
    """
SELECT * FROM raw_obs
WHERE created_at >= TIMESTAMP '2024-06-28 00:00:00' AND created_at <= TIMESTAMP '2024-06-30 00:00:00'""",
)
register("batch_dedup", "SELECT * FROM bat_latest", extra_ctes=MERGE)
register("merge_raw", "SELECT * FROM raw_merged", extra_ctes=MERGE)
EXTENDED_DATES = f"""
SELECT * FROM dim_date_tgt
UNION ALL
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT), d, CAST(year(d) AS INTEGER), CAST(month(d) AS INTEGER), monthname(d),
       CAST(dayofweek(d) + 1 AS INTEGER), CASE WHEN dayofweek(d) IN (0, 6) THEN 'weekend' ELSE 'weekday' END
FROM (SELECT DISTINCT CAST({local('created_at')} AS DATE) AS d FROM bat_latest WHERE created_at IS NOT NULL) AS n
WHERE d NOT IN (SELECT calendar_date FROM dim_date_tgt)"""
register("extend_dim_date", EXTENDED_DATES, extra_ctes=MERGE)
register("merge_fact", "SELECT * FROM fact_merged", extra_ctes=MERGE)
register(
    "rerun_idempotence",
    """
SELECT CAST((SELECT count(*) FROM (SELECT * FROM fact_merged EXCEPT ALL SELECT * FROM fact_again) AS a)
          + (SELECT count(*) FROM (SELECT * FROM fact_again EXCEPT ALL SELECT * FROM fact_merged) AS b) AS BIGINT)
         AS differing_rows,
       (SELECT CAST(count(*) AS BIGINT) FROM fact_again) AS fact_rows,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT source_observation_id FROM fact_again GROUP BY 1
                                              HAVING count(*) > 1) AS c) AS duplicate_ids""",
    extra_ctes=MERGE + """,
fact_again AS (
  SELECT * EXCLUDE (src) FROM (SELECT *, 0 AS src FROM fact_merged UNION ALL SELECT *, 1 AS src FROM fact_bat) AS u
  QUALIFY row_number() OVER (PARTITION BY source_observation_id ORDER BY src DESC) = 1
)""",
)

# ---------------------------------------------------------------- landed payloads
def uuid_sql(h: str) -> str:
    """Version-5 UUID text from a SHA-1 hex column ``h``."""
    return (
        f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
        f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({h}, 18, 3) || '-' || "
        f"substr({h}, 21, 12))"
    )


UUID = uuid_sql("h")
F4 = ("(CASE WHEN {d} < -60 THEN 'early' WHEN {d} <= 60 THEN 'on_time' WHEN {d} <= 180 THEN 'minor_delay' "
      "WHEN {d} <= 360 THEN 'medium_delay' WHEN {d} > 360 THEN 'major_delay' END)")

PAYLOADS = f"""pl AS (
  SELECT r.*, CAST(substr(trip_id, 3) AS BIGINT) AS ord, concat(collection_run_id, '/', trip_id) AS payload_id,
         max(created_at) OVER (PARTITION BY collection_run_id, trip_id) AS fetched_at,
         row_number() OVER (PARTITION BY collection_run_id, trip_id
                            ORDER BY stop_sequence, tie_1, tie_2, tie_3, tie_4) AS item_no
  FROM raw_obs AS r
),
scanned AS (
  SELECT payload_id, collection_run_id, trip_id, stop_id, fetched_at,
         CASE WHEN ord % 101 = 7 THEN NULL WHEN ord % 103 = 5 THEN 'ERROR' ELSE 'OK' END AS status,
         (ord % 101 <> 7 AND ord % 103 <> 5) AS accepted,
         CASE WHEN ord % 101 = 7 THEN 'invalid JSON'
              WHEN ord % 103 = 5 THEN 'status ERROR: upstream unavailable' END AS error_message
  FROM pl WHERE item_no = 1
),
kept AS (
  SELECT *, row_number() OVER (PARTITION BY payload_id ORDER BY item_no) - 1 AS position
  FROM pl WHERE tie_1 % 97 <> 1 AND ord % 101 <> 7 AND ord % 103 <> 5
),
parsed AS (
  SELECT *, {UUID} AS observation_id, {F4.format(d='delay')} AS delay_category
  FROM (SELECT payload_id, payload_id AS collection_run_id, route_id, stop_id, trip_id,
               coalesce(nullif(headsign, ''), '-') AS headsign,
               CASE WHEN ord % 50 = 0 THEN '' ELSE CAST(ord % 2 AS VARCHAR) END AS direction_id,
               CAST(stop_sequence AS BIGINT) AS stop_sequence, scheduled_departure,
               CASE WHEN tie_1 % 89 = 2 THEN scheduled_departure ELSE predicted_departure END AS predicted_departure,
               date_diff('second', scheduled_departure,
                         CASE WHEN tie_1 % 89 = 2 THEN scheduled_departure ELSE predicted_departure END) AS delay,
               fetched_at AS created_at, duplicate_key, CAST(position AS INTEGER) AS position,
               sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(duplicate_key)) AS h,
               collection_run_id AS collection
        FROM kept WHERE position < 4) AS k
),
flags AS (
  SELECT p.*, (p.first_in AND t.duplicate_key IS NULL) AS inserted
  FROM (SELECT *, row_number() OVER (PARTITION BY duplicate_key
                  ORDER BY created_at ASC NULLS LAST, payload_id, position) = 1 AS first_in FROM parsed) AS p
  LEFT JOIN (SELECT DISTINCT duplicate_key FROM obs WHERE created_at < TIMESTAMP '2024-05-01 00:00:00') AS t
    ON t.duplicate_key = p.duplicate_key
),
ent_stops AS (
  SELECT e.payload_id, e.fetched_at,
         CAST(row_number() OVER (PARTITION BY e.payload_id ORDER BY e.first_pos) - 1 AS INTEGER) AS position,
         e.id, coalesce(s.name, e.id) AS name, s.lat, s.lon
  FROM (SELECT payload_id, created_at AS fetched_at, stop_id AS id, min(position) AS first_pos
        FROM parsed GROUP BY ALL) AS e
  LEFT JOIN stops AS s ON s.id = e.id
),
ent_routes AS (
  SELECT e.payload_id, e.fetched_at,
         CAST(row_number() OVER (PARTITION BY e.payload_id ORDER BY e.first_pos) - 1 AS INTEGER) AS position,
         e.id, coalesce(r.short_name, e.id) AS short_name, coalesce(r.route_type, '') AS route_type
  FROM (SELECT payload_id, created_at AS fetched_at, route_id AS id, min(position) AS first_pos
        FROM parsed GROUP BY ALL) AS e
  LEFT JOIN routes AS r ON r.id = e.id
)"""

OBS_COLS = ("observation_id, collection_run_id, route_id, stop_id, trip_id, headsign, direction_id, stop_sequence, "
            "scheduled_departure, predicted_departure, delay AS delay_seconds, delay_category, created_at, "
            "duplicate_key")

register(
    "scan_payloads",
    "SELECT payload_id, collection_run_id, trip_id, stop_id, fetched_at, status, accepted, error_message FROM scanned",
    extra_ctes=PAYLOADS,
)
register("parse_departures", f"SELECT payload_id, {OBS_COLS}, position FROM parsed", extra_ctes=PAYLOADS)
register("first_seen_entities", "SELECT * FROM ent_stops", extra_ctes=PAYLOADS)
register("first_seen_routes", "SELECT * FROM ent_routes", extra_ctes=PAYLOADS)
register("collect_batch", f"SELECT payload_id, {OBS_COLS}, position FROM flags WHERE inserted", extra_ctes=PAYLOADS)
register(
    "collection_summary",
    """
SELECT c.collection_run_id, c.stops_requested, c.api_calls_succeeded, c.api_calls_failed,
       CAST(coalesce(g.generated, 0) AS BIGINT) AS observations_generated,
       CAST(coalesce(g.saved, 0) AS BIGINT) AS observations_saved,
       CAST(coalesce(g.generated, 0) - coalesce(g.saved, 0) AS BIGINT) AS duplicate_observations_skipped,
       CASE WHEN c.api_calls_failed > 0 AND c.api_calls_succeeded > 0 THEN 'partial_success'
            WHEN c.api_calls_failed > 0 THEN 'failed' ELSE 'success' END AS status
FROM (SELECT collection_run_id, CAST(count(*) AS BIGINT) AS stops_requested,
             CAST(count_if(accepted) AS BIGINT) AS api_calls_succeeded,
             CAST(count_if(NOT accepted) AS BIGINT) AS api_calls_failed
      FROM scanned GROUP BY 1) AS c
LEFT JOIN (SELECT collection AS collection_run_id, count(*) AS generated, count_if(inserted) AS saved
           FROM flags GROUP BY 1) AS g ON g.collection_run_id = c.collection_run_id""",
    extra_ctes=PAYLOADS,
)
register(
    "collection_errors",
    """
SELECT e.collection_run_id, e.payload_id, e.stop_id, s.name AS stop_name, e.error_message AS message
FROM scanned AS e LEFT JOIN stops AS s ON s.id = e.stop_id WHERE NOT e.accepted""",
    extra_ctes=PAYLOADS,
)
REQUESTED = PAYLOADS + """,
requested AS (
  SELECT r.collection_run_id, q.stop_id, q.stop_name
  FROM (SELECT DISTINCT collection_run_id FROM scanned) AS r,
       (SELECT concat('S_', i) AS stop_id, concat('Stop ', i // 2) AS stop_name FROM range(20) AS t(i)
        UNION ALL SELECT '', 'Blank') AS q
),
calls AS (
  SELECT r.collection_run_id, r.stop_id, r.stop_name, s.payload_id,
         CASE WHEN r.stop_id = '' THEN 'empty' WHEN s.accepted THEN 'success' ELSE 'failed' END AS call,
         CASE WHEN s.payload_id IS NULL THEN 'no payload' ELSE s.error_message END AS message
  FROM requested AS r
  LEFT JOIN scanned AS s ON s.collection_run_id = r.collection_run_id AND s.stop_id = r.stop_id
)"""
register(
    "collection_report",
    """
SELECT c.collection_run_id, c.stops_requested, c.api_calls_succeeded, c.api_calls_failed,
       CAST(coalesce(g.generated, 0) AS BIGINT) AS observations_generated,
       CAST(coalesce(g.saved, 0) AS BIGINT) AS observations_saved,
       CAST(coalesce(g.generated, 0) - coalesce(g.saved, 0) AS BIGINT) AS duplicate_observations_skipped,
       CASE WHEN c.api_calls_failed > 0 AND c.api_calls_succeeded > 0 THEN 'partial_success'
            WHEN c.api_calls_failed > 0 THEN 'failed' ELSE 'success' END AS status
FROM (SELECT collection_run_id, CAST(count(*) AS BIGINT) AS stops_requested,
             CAST(count_if(call = 'success') AS BIGINT) AS api_calls_succeeded,
             CAST(count_if(call = 'failed') AS BIGINT) AS api_calls_failed
      FROM calls GROUP BY 1) AS c
LEFT JOIN (SELECT collection AS collection_run_id, count(*) AS generated, count_if(inserted) AS saved
           FROM flags GROUP BY 1) AS g ON g.collection_run_id = c.collection_run_id""",
    extra_ctes=REQUESTED,
)
register(
    "collection_report_errors",
    "SELECT collection_run_id, payload_id, stop_id, stop_name, message FROM calls WHERE call = 'failed'",
    extra_ctes=REQUESTED,
)
UPSERT_ROUTES = """
SELECT id, short_name, route_type FROM (
  SELECT id, short_name, route_type, 0 AS src, NULL::TIMESTAMP AS fetched_at, '' AS payload_id FROM routes
  UNION ALL SELECT id, short_name, route_type, 1, fetched_at, payload_id FROM ent_routes) AS u
QUALIFY row_number() OVER (PARTITION BY id ORDER BY src DESC, fetched_at DESC NULLS FIRST, payload_id DESC) = 1"""
register("sink_upsert_routes", UPSERT_ROUTES, extra_ctes=PAYLOADS)
UPSERT_STOPS = """
SELECT id, name, lat, lon FROM (
  SELECT id, name, lat, lon, 0 AS src, NULL::TIMESTAMP AS fetched_at, '' AS payload_id FROM stops
  UNION ALL SELECT id, name, lat, lon, 1, fetched_at, payload_id FROM ent_stops) AS u
QUALIFY row_number() OVER (PARTITION BY id ORDER BY src DESC, fetched_at DESC NULLS FIRST, payload_id DESC) = 1"""
register("sink_upsert_stops", UPSERT_STOPS, extra_ctes=PAYLOADS)
register(
    "sink_upsert_runs",
    """
SELECT s.payload_id AS id, s.fetched_at AS started_at, s.fetched_at AS finished_at, 'success' AS status,
       CAST(coalesce(n.saved, 0) AS INTEGER) AS records_saved, '' AS error_message
FROM scanned AS s
LEFT JOIN (SELECT payload_id, count(*) AS saved FROM flags WHERE inserted GROUP BY 1) AS n
  ON n.payload_id = s.payload_id
WHERE s.accepted""",
    extra_ctes=PAYLOADS,
)

SEARCH = """srch AS (
  SELECT r.*, CAST(substr(trip_id, 3) AS BIGINT) AS ord, concat(collection_run_id, '/', trip_id) AS payload_id,
         row_number() OVER (PARTITION BY collection_run_id, trip_id
                            ORDER BY stop_sequence, tie_1, tie_2, tie_3, tie_4) AS item_no
  FROM raw_obs AS r
),
srch_first AS (
  SELECT payload_id, ord, stop_id, min(item_no) AS first_no,
         CASE ord % 5 WHEN 0 THEN 'R_3040' WHEN 1 THEN 'R_3060' WHEN 2 THEN 'R_0070'
              WHEN 3 THEN 'R_1050' ELSE 'R_5100' END AS trip_route
  FROM srch GROUP BY ALL
)"""
register(
    "search_stations",
    """
SELECT f.payload_id, CAST(f.position AS INTEGER) AS position, f.stop_id, s.name, s.id AS code, '' AS direction,
       s.lat, s.lon, f.trip_route AS route_ids_text, r.short_name AS route_number
FROM (SELECT *, row_number() OVER (PARTITION BY payload_id ORDER BY first_no) - 1 AS position FROM srch_first) AS f
JOIN stops AS s ON s.id = f.stop_id
JOIN routes AS r ON r.id = f.trip_route
WHERE f.position < 11 AND f.ord % 10 <> 0""",
    extra_ctes=SEARCH,
)

# ---------------------------------------------------------------- extraction and sinks
register(
    "extract_observations",
    """
SELECT observation_id, collection_run_id, route_id, stop_id, trip_id, headsign, direction_id,
       CAST(stop_sequence AS BIGINT) AS stop_sequence, created_at, scheduled_departure, predicted_departure,
       CAST(delay_seconds AS BIGINT) AS delay_seconds, delay_category, duplicate_key
FROM obs""",
)
register("sink_replace", "SELECT * FROM fact")
register(
    "landing_replace",
    """
SELECT * FROM raw_obs
WHERE created_at >= TIMESTAMP '2024-06-28 00:00:00' AND created_at <= TIMESTAMP '2024-06-30 00:00:00'""",
)
register("sink_fact_partitioned", "SELECT *, CAST(observed_at AS DATE) AS observed_date FROM fact")
register(
    "fact_local_date_range",
    f"""
SELECT *, CAST(observed_at AS DATE) AS observed_date FROM fact
WHERE CAST({local('observed_at')} AS DATE) BETWEEN DATE '2024-03-30' AND DATE '2024-04-01'""",
)
register("stream_collect", "SELECT * FROM obs")
register("stream_payloads", BODIES["collect_batch"], extra_ctes=PAYLOADS)
register(
    "stream_quarantine",
    "SELECT payload_id, collection_run_id, stop_id, fetched_at, error_message FROM scanned WHERE NOT accepted",
    extra_ctes=PAYLOADS,
)
register("stream_runs", BODIES["sink_upsert_runs"], extra_ctes=PAYLOADS)
register(
    "stream_overlap_counts",
    """
SELECT CAST(count(*) AS BIGINT) AS input_rows, CAST(count(DISTINCT duplicate_key) AS BIGINT) AS accepted,
       CAST(count(*) - count(DISTINCT duplicate_key) AS BIGINT) AS duplicates, CAST(0 AS BIGINT) AS late FROM raw_obs""",
)
register(
    "merge_fact_in_place",
    "SELECT *, CAST(observed_at AS DATE) AS observed_date FROM fact_merged",
    extra_ctes=MERGE,
)

# ---------------------------------------------------------------- history, rules, intermediate steps
register(
    "recent_history",
    f"""
SELECT o.observation_id, coalesce(nullif(s.name, ''), '-') AS station_name,
       coalesce(nullif(r.short_name, ''), '-') AS route_short_name,
       coalesce(nullif(o.headsign, ''), '-') AS destination_name,
       coalesce(strftime({local('o.scheduled_departure')}, '%H:%M'), '-') AS expected_departure,
       coalesce(strftime({local('o.predicted_departure')}, '%H:%M'), '-') AS realtime_departure,
       CAST(coalesce(o.delay_seconds, 0) AS VARCHAR) AS delay_seconds
FROM obs AS o JOIN stops AS s ON s.id = o.stop_id JOIN routes AS r ON r.id = o.route_id
ORDER BY o.created_at DESC NULLS LAST, o.observation_id
LIMIT 50""",
)

F8_O = F8.replace("delay_category", "o.delay_category").replace("delay_seconds", "o.delay_seconds")
F9_O = F9.replace("route_id", "o.route_id")
LT = local("o.created_at")
register(
    "scalar_rules",
    f"""
SELECT o.observation_id,
       CAST(year({LT}) * 10000 + month({LT}) * 100 + day({LT}) AS BIGINT) AS date_key,
       CAST(o.delay_seconds AS DOUBLE) / 60.0 AS delay_minutes,
       CASE WHEN o.delay_seconds <= 60 THEN 'on time' WHEN o.delay_seconds <= 180 THEN 'minor delay'
            WHEN o.delay_seconds <= 300 THEN 'significant delay' ELSE 'severe delay' END AS warehouse_category,
       {F4.format(d='o.delay_seconds')} AS operational_category,
       {period_of(f'hour({LT})')} AS time_period,
       date_diff('second', o.scheduled_departure, o.predicted_departure) AS recomputed_delay,
       {F8_O} AS display_category,
       {F9_O} AS route_number,
       {F10} AS normalized_headsign,
       coalesce(nullif(o.headsign, ''), 'unknown') AS clean_headsign,
       concat(o.trip_id, '|', o.stop_id, '|', strftime(o.scheduled_departure, '%Y-%m-%dT%H:%M:%S'), '+00:00')
         AS natural_key,
       {uuid_sql('o.hh')} AS stable_id,
       {LT} AS local_observed_at,
       CAST(hour({LT}) AS INTEGER) AS local_hour,
       CAST(dayofweek(CAST({LT} AS DATE)) + 1 AS INTEGER) AS local_day_of_week,
       coalesce(strftime({local('o.scheduled_departure')}, '%H:%M'), '-') AS scheduled_clock,
       date_diff('second', TIMESTAMP '1970-01-01 00:00:00', o.scheduled_departure) AS scheduled_epoch,
       o.scheduled_departure AS scheduled_from_epoch,
       CAST(o.created_at AS DATE) AS created_date,
       CASE WHEN CAST(o.delay_seconds AS DOUBLE) / 60.0 < 3.0 THEN 'target-ok' ELSE 'target-warning' END AS target_flag
FROM (SELECT *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(duplicate_key)) AS hh FROM obs) AS o""",
)

USABLE = "SELECT * FROM obs WHERE created_at IS NOT NULL AND delay_seconds IS NOT NULL AND delay_seconds >= 0"
register("usable_filter", USABLE)
DERIVE = f"""
SELECT observation_id AS source_observation_id,
       CAST(year(lt) * 10000 + month(lt) * 100 + day(lt) AS BIGINT) AS date_key,
       route_id, stop_id, collection_run_id, trip_id, headsign, direction_id,
       CAST(stop_sequence AS BIGINT) AS stop_sequence, created_at AS observed_at,
       scheduled_departure, predicted_departure, CAST(delay_seconds AS BIGINT) AS delay_seconds,
       CAST(delay_seconds AS DOUBLE) / 60.0 AS delay_minutes,
       CASE WHEN delay_seconds <= 60 THEN 'on time' WHEN delay_seconds <= 180 THEN 'minor delay'
            WHEN delay_seconds <= 300 THEN 'significant delay' ELSE 'severe delay' END AS delay_category,
       delay_category AS source_delay_category,
       {period_of('hour(lt)')} AS time_period,
       CAST(1 AS BIGINT) AS observation_count
FROM (SELECT *, {local('created_at')} AS lt FROM ({USABLE}) AS u) AS d"""
register("fact_derive", DERIVE)
register(
    "join_fact_route",
    "SELECT d.*, r.route_key FROM derived AS d JOIN dim_route AS r ON r.source_route_id = d.route_id",
    extra_ctes=f"derived AS ({DERIVE})",
)
register(
    "star_join",
    "SELECT * FROM v_all",
    extra_ctes="v_all AS (" + FIXTURE[FIXTURE.index("v AS (") + len("v AS ("):].rsplit(")", 1)[0]
    .replace("WHERE r.route_number IN ('4', '6')", "") + ")",
)
register(
    "tram_scope_from_id",
    "SELECT * FROM snap",
    extra_ctes=SNAP.split(",\nstop_groups AS")[0],
)

register(
    "join_fact_stop",
    """
SELECT d.*, r.route_key, s.stop_key FROM derived AS d
JOIN dim_route AS r ON r.source_route_id = d.route_id JOIN dim_stop AS s ON s.source_stop_id = d.stop_id""",
    extra_ctes=f"derived AS ({DERIVE})",
)
HISTORY = f"""
SELECT o.observation_id, coalesce(nullif(s.name, ''), '-') AS station_name,
       coalesce(nullif(r.short_name, ''), '-') AS route_short_name,
       coalesce(nullif(o.headsign, ''), '-') AS destination_name,
       coalesce(strftime({local('o.scheduled_departure')}, '%H:%M'), '-') AS expected_departure,
       coalesce(strftime({local('o.predicted_departure')}, '%H:%M'), '-') AS realtime_departure,
       CAST(coalesce(o.delay_seconds, 0) AS VARCHAR) AS delay_seconds
FROM obs AS o JOIN stops AS s ON s.id = o.stop_id JOIN routes AS r ON r.id = o.route_id"""
register("history_join", HISTORY)
register(
    "dim_resolution",
    """
SELECT f.source_observation_id, f.date_key, f.route_key, f.stop_key,
       d.date_key IS NOT NULL AS date_resolved, r.route_key IS NOT NULL AS route_resolved,
       s.stop_key IS NOT NULL AS stop_resolved
FROM fact AS f LEFT JOIN dim_date AS d ON d.date_key = f.date_key
LEFT JOIN dim_route AS r ON r.route_key = f.route_key LEFT JOIN dim_stop AS s ON s.stop_key = f.stop_key""",
)
register(
    "statistics_gate",
    """
SELECT (EXISTS (SELECT 1 FROM v) OR EXISTS (SELECT 1 FROM range(24))) AS has_dashboard_statistics,
       EXISTS (SELECT 1 FROM snap) AS has_legacy_statistics""",
    extra_ctes=SNAP,
)

register(
    "source_audit",
    f"""
SELECT CAST(count(*) AS BIGINT) AS observations, min(created_at) AS first_observed_at,
       max(created_at) AS last_observed_at, CAST(min(delay_seconds) AS BIGINT) AS min_delay_seconds,
       CAST(max(delay_seconds) AS BIGINT) AS max_delay_seconds,
       {rmean('sum(delay_seconds)', 'count(delay_seconds)', 1)} AS avg_delay_seconds,
       CAST(count(*) FILTER (WHERE observation_id IS NULL) AS BIGINT) AS missing_id,
       CAST(count(*) FILTER (WHERE route_id IS NULL OR route_id = '') AS BIGINT) AS missing_route_id,
       CAST(count(*) FILTER (WHERE stop_id IS NULL OR stop_id = '') AS BIGINT) AS missing_stop_id,
       CAST(count(*) FILTER (WHERE direction_id IS NULL OR direction_id = '') AS BIGINT) AS missing_direction_id,
       CAST(count(*) FILTER (WHERE created_at IS NULL) AS BIGINT) AS missing_created_at,
       CAST(count(*) FILTER (WHERE scheduled_departure IS NULL) AS BIGINT) AS missing_scheduled_departure,
       CAST(count(*) FILTER (WHERE predicted_departure IS NULL) AS BIGINT) AS missing_predicted_departure,
       CAST(count(*) FILTER (WHERE delay_seconds IS NULL) AS BIGINT) AS missing_delay_seconds,
       CAST(count(*) FILTER (WHERE delay_seconds < 0) AS BIGINT) AS negative_delay_seconds,
       (SELECT CAST(count(*) AS BIGINT) FROM obs AS o WHERE o.route_id NOT IN (SELECT id FROM routes)
           OR o.route_id IS NULL) AS observations_without_route,
       (SELECT CAST(count(*) AS BIGINT) FROM obs AS o WHERE o.stop_id NOT IN (SELECT id FROM stops)
           OR o.stop_id IS NULL) AS observations_without_stop
FROM obs""",
)
register(
    "warehouse_checks",
    """
SELECT (SELECT usable_raw_rows FROM rc) AS usable_raw_rows, (SELECT fact_rows FROM rc) AS fact_rows,
       (SELECT issue_count FROM dk WHERE issue = 'duplicate_fact_ids') AS duplicate_fact_ids,
       (SELECT issue_count FROM dk WHERE issue = 'duplicate_route_keys') AS duplicate_route_keys,
       (SELECT issue_count FROM dk WHERE issue = 'duplicate_stop_keys') AS duplicate_stop_keys,
       (SELECT issue_count FROM dk WHERE issue = 'duplicate_date_keys') AS duplicate_date_keys,
       wi.*
FROM wi""",
    extra_ctes=(
        "rc AS (" + RECONCILE + "),\n"
        "dk AS (" + DUPES.format(fact="fact", dim_date="dim_date") + "),\n"
        "wi AS (" + ISSUES.format(fact="fact") + ")"
    ),
)
CHECK_CTES = (
    "rc AS (" + RECONCILE + "),\n"
    "dk AS (" + DUPES.format(fact="fact", dim_date="dim_date") + "),\n"
    "wi AS (" + ISSUES.format(fact="fact") + ")"
)
CONTROL = """
SELECT CASE WHEN issue_count = 0 THEN 'success' ELSE 'failed' END AS status, fact_rows, issue_count
FROM (SELECT rc.fact_rows AS fact_rows,
             CAST(abs(rc.usable_raw_rows - rc.fact_rows) + (SELECT sum(issue_count) FROM dk)
                  + wi.missing_observation_id + wi.unresolved_date + wi.unresolved_route + wi.unresolved_stop
                  + wi.invalid_delay + wi.missing_observed_at + wi.local_date_mismatch
                  + wi.local_time_period_mismatch AS BIGINT) AS issue_count
      FROM rc, wi) AS c"""
register("etl_control_log", CONTROL, extra_ctes=CHECK_CTES)


def _fact_of_cycle(sql: str) -> str:
    """The checks over the merged tables of a cycle instead of the first build."""
    return re.sub(r"\bobs\b", "raw_merged", re.sub(r"\bfact\b", "fact_merged", re.sub(r"\bdim_date\b", "dim_date_cycle", sql)))


register(
    "incremental_cycle",
    CONTROL,
    extra_ctes=MERGE + """,
dim_date_cycle AS (""" + EXTENDED_DATES + """
),
""" + _fact_of_cycle(CHECK_CTES),
)


def _all_routes_known(sql: str) -> str:
    """The same with the route that the operational table lacks."""
    known = """dim_route_known AS (
  SELECT * FROM dim_route UNION ALL SELECT 'R_9999', 'R_9999', '9999', 'BUS line 9999', 'BUS'
),
"""
    return known + re.sub(r"\bdim_route\b", "dim_route_known", sql)


USABLE_BATCH = MERGE.replace(
    "AND created_at <= TIMESTAMP '2024-06-30 00:00:00'", "AND created_at <= TIMESTAMP '2024-06-30 00:00:00' AND delay_seconds + 5 >= 0")
register(
    "published_cycle", "SELECT *, CAST(observed_at AS DATE) AS observed_date FROM fact_merged",
    extra_ctes=_all_routes_known(USABLE_BATCH),
)
register(
    "failed_cycle_unpublished", "SELECT *, CAST(observed_at AS DATE) AS observed_date FROM fact_tgt",
    extra_ctes=_all_routes_known(MERGE),
)
PAGE_PARTS = ("kpi_summary", "stop_delay_ranking", "daily_delay_trend", "hourly_delay_trend", "delay_category_breakdown",
              "time_period_delay_matrix")
register("page_statistics", stacked({p: p for p in PAGE_PARTS}))
register("snapshot_statistics", stacked({
    "kpi_summary": "snap_kpi", "stop_delay_ranking": "snap_stop_ranking", "daily_delay_trend": "snap_daily_trend",
    "hourly_delay_trend": "snap_hourly_trend", "delay_category_breakdown": "snap_category_breakdown",
    "time_period_delay_matrix": "snap_time_period_matrix", "average_delay_by_stop": "average_delay_by_stop",
    "delayed_ratio_by_period": "delayed_ratio_by_period", "most_problematic_stops": "most_problematic_stops",
}), extra_ctes=SNAP)
register(
    "dashboard_sql",
    """
SELECT route_number, delay_category, CAST(sum(observation_count) AS BIGINT) AS observation_count,
       CAST(sum(delayed_count) AS BIGINT) AS delayed_count, max(delay_seconds) AS max_delay_seconds
FROM v WHERE day_type = 'weekday' GROUP BY route_number, delay_category""",
)
register(
    "cycle_checks",
    BODIES["warehouse_checks"],
    extra_ctes=MERGE + """,
dim_date_cycle AS (""" + EXTENDED_DATES + """
),
""" + _fact_of_cycle(CHECK_CTES),
)
register("sink_fact_interleaved", "SELECT *, CAST(observed_at AS DATE) AS observed_date FROM fact")
register("extract_splits", "SELECT observation_id, 1 AS splits FROM obs")
register("latest_history", BODIES["recent_history"])
register("stream_dedup_overlap", "SELECT DISTINCT duplicate_key FROM raw_obs")
register("run_scoped_ids", f"""
SELECT observation_id, {UUID} AS run_scoped_id
FROM (SELECT observation_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(concat(
         collection_run_id, '|', duplicate_key, '|', stop_sequence))) AS h FROM obs) AS k""")
register("kpi_display", f"""
SELECT avg_delay_minutes, CASE WHEN avg_delay_minutes < 3 THEN 'target-ok' ELSE 'target-warning' END AS target_flag,
       printf('%.2f min', avg_delay_minutes) AS avg_delay_text,
       CASE WHEN obs > 0 THEN concat(tenths // 10, '.', tenths % 10, '%') ELSE '0.0%' END AS delayed_text
FROM (SELECT coalesce({MIN}, 0.0) AS avg_delay_minutes, sum(observation_count) AS obs,
             CAST((sum(delayed_count) * 2000 + sum(observation_count)) // nullif(sum(observation_count) * 2, 0) AS BIGINT)
               AS tenths
      FROM v) AS k""")


def _schema_audit_sql() -> str:
    source = {"collection_runs": "runs", "delay_observations": "obs", "routes": "routes", "stops": "stops"}
    rows = []
    for table, cte in source.items():
        for i, f in enumerate(schemas.ALL_TABLES[f"transit_data/{table}"].fields, start=1):
            column = "observation_id" if (table, f.name) == ("delay_observations", "id") else f.name
            rows.append(f"SELECT '{table}' AS table_name, {i} AS ordinal_position, '{f.name}' AS column_name, "
                        f"'{'YES' if f.nullable else 'NO'}' AS is_nullable, "
                        f"CAST(count(*) FILTER (WHERE {column} IS NULL) AS BIGINT) AS null_count FROM {cte}")
    return " UNION ALL ".join(rows)


register("schema_audit", _schema_audit_sql(), extra_ctes="""runs AS (
  SELECT collection_run_id AS id, min(created_at) AS started_at, max(created_at) AS finished_at,
         'success' AS status, 0 AS records_saved, '' AS error_message
  FROM obs GROUP BY collection_run_id)""")
# A copy of what the collector's upserts left in the store
register("extract_routes", UPSERT_ROUTES, extra_ctes=PAYLOADS)
register("extract_stops", UPSERT_STOPS, extra_ctes=PAYLOADS)
register(
    "looker_metrics_date_range",
    f"""
SELECT route_number, calendar_date, delay_category,
       {MIN} AS avg_delay_minutes, {rmean('max(delay_seconds)', '1')} AS max_delay_minutes,
       CAST(sum(observation_count) AS BIGINT) AS observation_count,
       CAST(sum(delayed_count) AS DOUBLE) / nullif(sum(observation_count), 0) AS delayed_share
FROM v WHERE calendar_date BETWEEN DATE '2024-03-25' AND DATE '2024-04-07'
GROUP BY route_number, calendar_date, delay_category""",
)


def bar_sql(source_cte: str, value: str) -> str:
    return (f"SELECT d.*, CASE WHEN m.top > 0 THEN d.{value} / m.top * 100.0 ELSE 0.0 END AS bar_percent "
            f"FROM {source_cte} AS d, (SELECT max({value}) AS top FROM {source_cte}) AS m")


register("relative_bar_ranking", bar_sql("ranked", "avg_delay_minutes"), extra_ctes=f"ranked AS ({RANKING})")
register(
    "relative_bar_hourly",
    bar_sql("hourly", "avg_delay_minutes"),
    extra_ctes=f"""hourly AS (
  SELECT h.observed_hour, coalesce({rmean('g.w', 'g.n', 100)}, 0.0) AS avg_delay_minutes,
         CAST(coalesce(g.n, 0) AS BIGINT) AS observation_count
  FROM (SELECT CAST(i AS INTEGER) AS observed_hour FROM range(24) AS q(i)) AS h
  LEFT JOIN (SELECT observed_hour AS hr, sum(CAST(round(avg_delay_minutes * 100) AS BIGINT) * observation_count) AS w,
                    sum(observation_count) AS n
             FROM ({HOURLY}) AS p GROUP BY 1) AS g ON g.hr = h.observed_hour)""",
)
register(
    "relative_bar_category",
    bar_sql("cats", "observation_count"),
    extra_ctes="""cats AS (
  SELECT delay_category, CAST(sum(observation_count) AS BIGINT) AS observation_count FROM v GROUP BY delay_category)""",
)
