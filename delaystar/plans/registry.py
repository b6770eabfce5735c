"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the shared test tables and builds only what it needs through a
per-call :class:`Job`.  Queries are lazy, except that dimensions are checkpointed
and size-checked, and the sink/stream queries write below the checkpoint folder
and return what they wrote, read back.  Nothing is collected to the driver.
The DuckDB twin of each name lives in :mod:`delaystar.plans.oracle`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaystar import schemas
from delaystar import settings as S
from delaystar.functions import columns as C
from delaystar.functions import identity
from delaystar.operators import dedup, incremental, ingest, partition_checks, quality, reporting, rules, snapshot, warehouse
from delaystar.session import dimension, ensure_checkpoint_dir, scratch_path
from delaystar.sources import extract, payloads, sinks, snapshots, testdata
from delaystar.streaming import collector, payload_stream


class Job:
    """Inputs and intermediate tables of one query run (built lazily)."""

    def __init__(self, spark: SparkSession, sf_dir: str, zone: str = S.LOCAL_ZONE):
        self.spark = spark
        self.sf_dir = sf_dir
        self.zone = zone
        ensure_checkpoint_dir(spark)

    @cached_property
    def raw(self) -> DataFrame:
        """Collected observations, duplicates included."""
        return testdata.raw_observations(self.spark, self.sf_dir)

    @cached_property
    def observations(self) -> DataFrame:
        """Operational store: first observation per duplicate_key."""
        return dedup.dedup_first_by_key(self.raw)

    @cached_property
    def routes(self) -> DataFrame:
        return testdata.routes(self.spark, self.sf_dir)

    @cached_property
    def stops(self) -> DataFrame:
        return testdata.stops(self.spark, self.sf_dir)

    @cached_property
    def wh(self) -> warehouse.Warehouse:
        return warehouse.build_warehouse(self.observations, self.routes, self.stops, self.zone)

    @cached_property
    def view(self) -> DataFrame:
        return warehouse.dashboard_view(self.wh)


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Callable[[Job], DataFrame]) -> Callable[[Job], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir, _fn=fn: _fn(Job(spark, sf_dir))
        return fn

    return deco


# ---------------------------------------------------------------- warehouse
@query("build_dim_date")
def _q_dim_date(j: Job) -> DataFrame:
    return warehouse.build_dim_date(j.observations, j.zone)


@query("build_dim_route")
def _q_dim_route(j: Job) -> DataFrame:
    return warehouse.build_dim_route(j.routes)


@query("build_dim_stop")
def _q_dim_stop(j: Job) -> DataFrame:
    return warehouse.build_dim_stop(j.stops)


@query("build_fact")
def _q_fact(j: Job) -> DataFrame:
    return j.wh.fact


@query("dashboard_view")
def _q_view(j: Job) -> DataFrame:
    return j.view


# ---------------------------------------------------------------- statistics
@query("kpi_summary")
def _q_kpi(j: Job) -> DataFrame:
    return reporting.kpi_summary(j.view)


@query("stop_delay_ranking")
def _q_ranking(j: Job) -> DataFrame:
    return reporting.stop_delay_ranking(j.view)


@query("daily_delay_trend")
def _q_daily(j: Job) -> DataFrame:
    return reporting.daily_delay_trend(j.view)


@query("hourly_delay_trend")
def _q_hourly(j: Job) -> DataFrame:
    return reporting.hourly_delay_trend(j.view)


@query("delay_category_breakdown")
def _q_category(j: Job) -> DataFrame:
    return reporting.delay_category_breakdown(j.view)


@query("time_period_delay_matrix")
def _q_matrix(j: Job) -> DataFrame:
    return reporting.time_period_delay_matrix(j.view)


@query("time_period_pivot")
def _q_pivot(j: Job) -> DataFrame:
    return reporting.time_period_pivot(reporting.time_period_delay_matrix(j.view))


@query("hourly_merge")
def _q_hourly_merge(j: Job) -> DataFrame:
    """Partial rows per (hour, route) merged into 24 hourly rows."""
    return reporting.hourly_merge(reporting.hourly_partials(j.view))


@query("relative_bar")
def _q_bar(j: Job) -> DataFrame:
    return reporting.relative_bar(reporting.daily_delay_trend(j.view), "avg_delay_minutes")


@query("conditional_sum")
def _q_condsum(j: Job) -> DataFrame:
    return reporting.conditional_sum(j.view)


@query("looker_metrics")
def _q_looker(j: Job) -> DataFrame:
    return reporting.looker_metrics(j.view)


@query("page_statistics")
def _q_page_statistics(j: Job) -> DataFrame:
    """The six statistics from one pass over the view."""
    return reporting.page_statistics(j.view)


@query("dashboard_sql")
def _q_dashboard_sql(j: Job) -> DataFrame:
    """The view registered under its name and asked through SQL."""
    name = warehouse.register_dashboard_view(j.wh)
    return j.spark.sql(f"""
        SELECT route_number, delay_category, sum(observation_count) AS observation_count, sum(delayed_count) AS delayed_count,
               max(delay_seconds) AS max_delay_seconds
        FROM {name} WHERE day_type = 'weekday' GROUP BY route_number, delay_category""")


# ---------------------------------------------------------------- source audit (C11)
def _source_tables(j: Job) -> dict[str, DataFrame]:
    return {
        "collection_runs": testdata.collection_runs(j.observations),
        "delay_observations": j.observations,
        "routes": j.routes,
        "stops": j.stops,
    }


@query("table_row_counts")
def _q_counts(j: Job) -> DataFrame:
    return quality.table_row_counts(_source_tables(j))


@query("source_distribution")
def _q_distribution(j: Job) -> DataFrame:
    return quality.source_distribution(j.observations)


@query("mandatory_field_audit")
def _q_mandatory(j: Job) -> DataFrame:
    return quality.mandatory_field_audit(j.observations)


@query("join_coverage")
def _q_coverage(j: Job) -> DataFrame:
    return quality.join_coverage(j.observations, j.routes, j.stops)


@query("audit_preview")
def _q_preview(j: Job) -> DataFrame:
    return quality.audit_preview(j.observations)


@query("schema_audit")
def _q_schema(j: Job) -> DataFrame:
    tables = _source_tables(j) | {"delay_observations": extract.operational_observations(j.observations)}
    return quality.schema_audit({name: (df, schemas.ALL_TABLES[f"transit_data/{name}"]) for name, df in tables.items()})


# ---------------------------------------------------------------- warehouse checks
@query("reconcile_counts")
def _q_reconcile(j: Job) -> DataFrame:
    return quality.reconcile_counts(j.spark, j.observations, j.wh.fact)


@query("duplicate_key_report")
def _q_dupes(j: Job) -> DataFrame:
    """Run on a build from the undeduplicated history, so fact ids repeat."""
    return quality.duplicate_key_report(warehouse.build_warehouse(j.raw, j.routes, j.stops, j.zone))


@query("warehouse_issue_row")
def _q_issues(j: Job) -> DataFrame:
    return quality.warehouse_issue_row(j.wh)


@query("warehouse_issue_row_utc_build")
def _q_issues_utc(j: Job) -> DataFrame:
    """A build that takes the local clock as UTC: the local-time checks must fire."""
    return quality.warehouse_issue_row(
        warehouse.build_warehouse(j.observations, j.routes, j.stops, j.zone, fact_zone="UTC"))


# ---------------------------------------------------------------- snapshot statistics
def _snap(j: Job) -> DataFrame:
    return snapshot.snapshot_input(j.raw, j.stops, j.zone)


for _name, _fn in {
    "snap_kpi": snapshot.snap_kpi,
    "snap_stop_ranking": snapshot.snap_stop_ranking,
    "snap_daily_trend": snapshot.snap_daily_trend,
    "snap_hourly_trend": snapshot.snap_hourly_trend,
    "snap_category_breakdown": snapshot.snap_category_breakdown,
    "snap_time_period_matrix": snapshot.snap_time_period_matrix,
    "average_delay_by_stop": snapshot.average_delay_by_stop,
    "delayed_ratio_by_period": snapshot.delayed_ratio_by_period,
    "most_problematic_stops": snapshot.most_problematic_stops,
}.items():
    query(_name)(lambda j, _f=_fn: _f(_snap(j)))


@query("snapshot_statistics")
def _q_snapshot_statistics(j: Job) -> DataFrame:
    """The nine statistics from one pass over the observations."""
    return snapshot.snapshot_statistics(_snap(j))


# ---------------------------------------------------------------- dedup, sinks, merge
AS_OF = dt.datetime(2024, 6, 30)


#: The store's history ends inside the overlap window, so a batch both updates and inserts.
TARGET_UNTIL = dt.datetime(2024, 6, 29)


def _collected_before(j: Job, until: dt.datetime) -> DataFrame:
    """The first observations of each key, of those collected before ``until``.

    Arrival orders by ``created_at``, missing last, so the first of a key is before ``until`` if any
    is: later rows are left out before the shuffle.
    """
    return dedup.dedup_first_by_key(j.raw.filter(F.col("created_at") < C.ntz_literal(until)))


def _merge_target(j: Job) -> DataFrame:
    """The store before the cycle: what was collected before TARGET_UNTIL."""
    return _collected_before(j, TARGET_UNTIL)


def _merge_batch(j: Job) -> DataFrame:
    """The overlap window before AS_OF, re-delivered with corrected delays (+5 s)."""
    return incremental.overlap_extract(j.raw, AS_OF).withColumn("delay_seconds", F.col("delay_seconds") + 5)


@query("dedup_first_by_key")
def _q_first(j: Job) -> DataFrame:
    return j.observations


@query("dedup_latest_by_id")
def _q_latest(j: Job) -> DataFrame:
    return dedup.dedup_latest_by_id(j.raw)


HISTORY_UNTIL = dt.datetime(2024, 5, 1)


def _history(j: Job) -> DataFrame:
    """The store so far: what was collected before HISTORY_UNTIL."""
    return _collected_before(j, HISTORY_UNTIL)


def _accepted(j: Job) -> DataFrame:
    """All collected observations inserted into the history so far."""
    return dedup.insert_ignore(_history(j), j.raw)


@query("insert_ignore")
def _q_insert_ignore(j: Job) -> DataFrame:
    return _accepted(j).select(*j.raw.columns)


@query("save_summary")
def _q_save_summary(j: Job) -> DataFrame:
    return dedup.save_summary(j.raw, _accepted(j))


@query("run_records_saved")
def _q_records_saved(j: Job) -> DataFrame:
    return dedup.run_records_saved(testdata.collection_runs(j.raw), _accepted(j))


@query("overlap_extract")
def _q_overlap(j: Job) -> DataFrame:
    return incremental.overlap_extract(j.raw, AS_OF)


@query("batch_dedup")
def _q_batch_dedup(j: Job) -> DataFrame:
    return incremental.batch_dedup(_merge_batch(j))


@query("merge_raw")
def _q_merge_raw(j: Job) -> DataFrame:
    return incremental.merge_raw(_merge_target(j), incremental.batch_dedup(_merge_batch(j)))


def _cycle(j: Job) -> incremental.CycleResult:
    target = dimension(_merge_target(j))
    wh = warehouse.build_warehouse(target, j.routes, j.stops, j.zone, stored=True)
    return incremental.incremental_cycle(wh, target, _merge_batch(j), j.routes, j.stops)


@query("extend_dim_date")
def _q_extend_dates(j: Job) -> DataFrame:
    return _cycle(j).dim_date


@query("merge_fact")
def _q_merge_fact(j: Job) -> DataFrame:
    return _cycle(j).fact


def _loaded(j: Job, name: str, routes: DataFrame) -> str:
    """A published warehouse of the target history; the cycles start from it."""
    target = dimension(_merge_target(j))
    root = scratch_path(j.spark, name)
    incremental.initial_load(root, warehouse.build_warehouse(target, routes, j.stops, j.zone, stored=True), target)
    return root


def _all_routes(j: Job) -> DataFrame:
    """The routes with the one that the operational table lacks, so that no row is lost and the audit passes."""
    return j.routes.unionByName(j.spark.createDataFrame([("R_9999", "9999", "BUS")], j.routes.schema))


@query("incremental_cycle")
def _q_cycle(j: Job) -> DataFrame:
    """The whole cycle, written, audited and logged; the unknown route makes it a failed one."""
    root = _loaded(j, "cycle", j.routes)
    return incremental.run_cycle(root, _merge_batch(j), j.routes, j.stops).log.select("status", "fact_rows", "issue_count")


@query("published_cycle")
def _q_published_cycle(j: Job) -> DataFrame:
    """The fact that readers see after a cycle that passed its audit (a batch of usable rows, all routes known)."""
    routes = _all_routes(j)
    root = _loaded(j, "cycle-published", routes)
    incremental.run_cycle(root, warehouse.usable_filter(_merge_batch(j)), routes, j.stops)
    return snapshots.published(j.spark, root).table(incremental.FACT)


@query("failed_cycle_unpublished")
def _q_failed_cycle(j: Job) -> DataFrame:
    """The fact that readers see after a cycle whose audit failed (it lost the rows of one route): as before it."""
    root = _loaded(j, "cycle-failed", _all_routes(j))
    incremental.run_cycle(root, _merge_batch(j), j.routes, j.stops)
    return snapshots.published(j.spark, root).table(incremental.FACT)


@query("cycle_checks")
def _q_cycle_checks(j: Job) -> DataFrame:
    """C12 of a cycle's proposed set, from the counters kept per day."""
    root = _loaded(j, "cycle-checks", j.routes)
    parent = snapshots.published(j.spark, root)
    proposed = incremental.propose_cycle(parent, _merge_batch(j), j.routes, j.stops, "cycle")
    return partition_checks.stage_checks(proposed, parent, "cycle")[0]


@query("latest_history")
def _q_latest_history(j: Job) -> DataFrame:
    """C10 on the stored history: only the days that can be on the page are opened."""
    root = scratch_path(j.spark, "history")
    staged = snapshots.stage(j.observations.withColumn("created_day", F.to_date("created_at")), root, "raw", "v1", by="created_day",
                             order=("observation_id",), newest_of="created_at")
    tables = snapshots.empty_set(j.spark, root).with_staged(staged)
    return reporting.latest_history(tables, "raw", j.stops, j.routes, S.HISTORY_LIMIT, j.zone)


@query("rerun_idempotence")
def _q_rerun(j: Job) -> DataFrame:
    first = _cycle(j)
    raw, fact = first.store()
    stored = warehouse.Warehouse(first.dim_date, first.dim_route, first.dim_stop, fact, j.zone)
    second = incremental.incremental_cycle(stored, raw, _merge_batch(j), j.routes, j.stops)
    return incremental.rerun_differences(fact, second.fact, "source_observation_id")


# ---------------------------------------------------------------- landed payloads (S1, C1..C3)
def _scanned(j: Job) -> DataFrame:
    return ingest.scan_payloads(payloads.departure_payloads(j.raw, j.routes, j.stops))


def _parsed(j: Job) -> DataFrame:
    return ingest.parse_departures(_scanned(j), S.COLLECTOR_DEPARTURE_LIMIT)


def _collect_accepted(j: Job) -> DataFrame:
    return ingest.collect_parsed(_history(j), dimension(_parsed(j)))


def _landed_payloads(j: Job) -> tuple[DataFrame, DataFrame]:
    """(scanned, parsed) payloads from one written parse, for queries that read both."""
    rows = dimension(ingest.parse_payloads(_scanned(j), S.COLLECTOR_DEPARTURE_LIMIT))
    return rows.withColumnsRenamed({"collection_id": "collection_run_id", "_requested": "stop_id"}), rows.where("accepted")


@query("scan_payloads")
def _q_scan(j: Job) -> DataFrame:
    return _scanned(j).select("payload_id", "collection_run_id", "trip_id", "stop_id", "fetched_at", "status",
                              "accepted", "error_message")


@query("parse_departures")
def _q_parse(j: Job) -> DataFrame:
    return ingest.parsed_observations(_parsed(j)).drop("collection_id")


@query("first_seen_entities")
def _q_first_seen_stops(j: Job) -> DataFrame:
    return ingest.parsed_stops(_parsed(j))


@query("first_seen_routes")
def _q_first_seen_routes(j: Job) -> DataFrame:
    return ingest.parsed_routes(_parsed(j))


@query("search_stations")
def _q_search(j: Job) -> DataFrame:
    return ingest.search_stations(payloads.search_payloads(j.raw, j.routes, j.stops), S.SEARCH_LIMIT)


@query("collect_batch")
def _q_collect(j: Job) -> DataFrame:
    return _collect_accepted(j).drop("collection_id")


@query("collection_summary")
def _q_collection_summary(j: Job) -> DataFrame:
    scanned, parsed = _landed_payloads(j)
    return ingest.collection_summary(scanned, ingest.observation_rows(parsed), ingest.collect_parsed(_history(j), parsed))


@query("collection_errors")
def _q_collection_errors(j: Job) -> DataFrame:
    """Every stop of the stop table is requested by name in each run that collected it."""
    scanned = _stored_scan(j)
    wanted = scanned.select("collection_run_id", "stop_id").distinct().join(
        j.stops.select(F.col("id").alias("stop_id"), F.col("name").alias("stop_name")), "stop_id", "left")
    return ingest.collection_errors(scanned, wanted)


def _stored_scan(j: Job) -> DataFrame:
    """What a report reads of the scanned payloads, written once."""
    return dimension(_scanned(j).select("collection_run_id", "payload_id", "stop_id", "accepted", "error_message"))


def _requested(j: Job, scanned: DataFrame) -> DataFrame:
    """The stops that every collection asks for, a blank id among them; not all have landed in each."""
    asked = [(f"S_{i}", f"Stop {i // 2}") for i in range(testdata.STOP_COUNT)] + [("", "Blank")]
    return ingest.requested_stops(scanned, j.spark.createDataFrame(asked, "stop_id string, stop_name string"))


@query("collection_report")
def _q_collection_report(j: Job) -> DataFrame:
    """A15 over the requested stops: landed, missing and blank ones."""
    scanned, parsed = _landed_payloads(j)
    return ingest.collection_summary(scanned, ingest.observation_rows(parsed), ingest.collect_parsed(_history(j), parsed),
                                     requested=_requested(j, scanned))


@query("collection_report_errors")
def _q_collection_report_errors(j: Job) -> DataFrame:
    scanned = _stored_scan(j)
    return ingest.collection_errors(scanned, _requested(j, scanned))


@query("sink_upsert_routes")
def _q_upsert_routes(j: Job) -> DataFrame:
    return ingest.upsert_entities(j.routes, ingest.parsed_routes(_parsed(j)))


@query("sink_upsert_stops")
def _q_upsert_stops(j: Job) -> DataFrame:
    return ingest.upsert_entities(j.stops, ingest.parsed_stops(_parsed(j)))


@query("sink_upsert_runs")
def _q_upsert_runs(j: Job) -> DataFrame:
    """Runs are inserted with records_saved 0, then upserted with the inserted count (S7 + S9)."""
    parsed = dimension(_parsed(j).select("payload_id", "collection_id", "fetched_at", "_kept"))
    started = ingest.parsed_runs(parsed)
    accepted = ingest.collect_parsed(_history(j), parsed)
    final = dedup.run_records_saved(started, accepted, run="collection_run_id")
    batch = final.select("*", F.col("started_at").alias("fetched_at"), F.col("id").alias("payload_id"),
                         F.lit(0).alias("position"))
    return ingest.upsert_entities(started, batch)


# ---------------------------------------------------------------- extraction and sinks
@query("extract_observations")
def _q_extract(j: Job) -> DataFrame:
    return extract.extract_observations(extract.operational_observations(j.observations))


@query("sink_replace")
def _q_sink_replace(j: Job) -> DataFrame:
    root = scratch_path(j.spark, "fact-replace")
    sinks.replace_table(j.wh.fact, root)
    return sinks.read_current(j.spark, root)


@query("landing_replace")
def _q_landing(j: Job) -> DataFrame:
    root = scratch_path(j.spark, "landing")
    sinks.replace_table(incremental.overlap_extract(j.raw, AS_OF), root)
    return sinks.read_current(j.spark, root)


def _stored_warehouse(j: Job) -> warehouse.Warehouse:
    """The warehouse of the operational store, written: a range-partitioned write reads its input twice."""
    return warehouse.build_warehouse(dimension(j.observations), j.routes, j.stops, j.zone, stored=True)


def _written_fact(j: Job) -> DataFrame:
    path = scratch_path(j.spark, "fact")
    sinks.write_fact_partitioned(_stored_warehouse(j).fact, path)
    return sinks.read_fact(j.spark, path)


@query("sink_fact_partitioned")
def _q_fact_partitioned(j: Job) -> DataFrame:
    return _written_fact(j)


@query("sink_fact_interleaved")
def _q_fact_interleaved(j: Job) -> DataFrame:
    """S10 clustered on route and stop alike, read back."""
    path = scratch_path(j.spark, "fact-interleaved")
    wh = _stored_warehouse(j)
    sinks.write_fact_interleaved(wh.fact, path, wh.dim_route, wh.dim_stop, stored=True)
    return sinks.read_fact(j.spark, path)


@query("extract_splits")
def _q_extract_splits(j: Job) -> DataFrame:
    """S4 in planned splits: the observations read split by split, with the number of splits that hold each id."""
    source = extract.operational_observations(j.observations)
    source.createOrReplaceTempView("delay_observations_source")
    histogram = j.spark.sql(extract.histogram_sql("delay_observations_source")).collect()
    planned = extract.plan_splits([tuple(r) for r in histogram], 16)
    held = F.array_size(F.filter(F.array(*[F.expr(p) for p in planned]), lambda x: F.coalesce(x, F.lit(False))))
    return source.select(F.col("id").alias("observation_id"), held.alias("splits"))


@query("fact_local_date_range")
def _q_fact_dates(j: Job) -> DataFrame:
    """Local dates around the spring DST change, read with UTC-date partition pruning."""
    return sinks.fact_for_local_dates(_written_fact(j), "2024-03-30", "2024-04-01", j.zone)


@query("etl_control_log")
def _q_control(j: Job) -> DataFrame:
    """The log row without its id and time."""
    checks = dimension(quality.warehouse_checks(j.spark, j.observations, j.wh))
    return sinks.log_cycle(checks, scratch_path(j.spark, "etl_control")).select("status", "fact_rows", "issue_count")


# ---------------------------------------------------------------- streaming
def _landed(j: Job) -> str:
    landing = scratch_path(j.spark, "landing-files")
    collector.land_observation_files(j.raw, landing)
    return landing


@query("stream_collect")
def _q_stream_collect(j: Job) -> DataFrame:
    landing = _landed(j)
    return collector.stream_collect(
        j.spark, f"{landing}/*", j.raw.schema, scratch_path(j.spark, "store"), scratch_path(j.spark, "ckpt-collect"))


@query("stream_dedup_overlap")
def _q_stream_overlap(j: Job) -> DataFrame:
    """The keys that the bounded-state dedup lets through, all files in one micro-batch."""
    landing = _landed(j)
    return collector.stream_dedup_overlap(
        j.spark, f"{landing}/*", j.raw.schema, scratch_path(j.spark, "dedup-out"), scratch_path(j.spark, "ckpt-dedup")
    ).select("duplicate_key")


@query("stream_overlap_counts")
def _q_stream_counts(j: Job) -> DataFrame:
    """I9 without loss: rows by outcome over the micro-batches."""
    counts = collector.stream_overlap(j.spark, f"{_landed(j)}/*", j.raw.schema, scratch_path(j.spark, "overlap"), scratch_path(j.spark, "ckpt-overlap"))
    return counts.agg(*[F.sum(c).alias(c) for c in ("input_rows", "accepted", "duplicates", "late")])


def _payload_store(j: Job) -> str:
    """Landed payload files, drained into a store that has the history so far."""
    root, landing = scratch_path(j.spark, "payload-store"), scratch_path(j.spark, "payload-files")
    payload_stream.land_payload_files(payloads.departure_payloads(j.raw, j.routes, j.stops), landing)
    payload_stream.seed_store(_history(j), root)
    payload_stream.stream_payloads(j.spark, landing, root, scratch_path(j.spark, "ckpt-payloads"))
    return root


@query("stream_payloads")
def _q_stream_payloads(j: Job) -> DataFrame:
    """The observations that the payload stream added to the store."""
    added = payload_stream.batches(j.spark, _payload_store(j), "delay_observations").where("batch_id >= 0")
    return added.drop("collection_id", "scheduled_date", "batch_id")


@query("stream_quarantine")
def _q_stream_quarantine(j: Job) -> DataFrame:
    """What the payload stream could not use, with the reason."""
    bad = payload_stream.read_store(j.spark, _payload_store(j), "quarantine")
    return bad.select("payload_id", "collection_run_id", "stop_id", "fetched_at", "error_message")


@query("stream_runs")
def _q_stream_runs(j: Job) -> DataFrame:
    """Runs with the number of observations that the stream inserted for each."""
    return payload_stream.read_store(j.spark, _payload_store(j), "collection_runs")


@query("merge_fact_in_place")
def _q_merge_in_place(j: Job) -> DataFrame:
    """I4 on the stored, date-partitioned fact: only the batch's dates are rewritten."""
    target = dimension(_merge_target(j))
    wh = warehouse.build_warehouse(target, j.routes, j.stops, j.zone, stored=True)
    path = scratch_path(j.spark, "fact-merge")
    sinks.write_fact_partitioned(wh.fact, path, located_by="scheduled_departure")
    batch = dimension(incremental.batch_dedup(_merge_batch(j)))
    batch_fact = warehouse.build_fact(batch, wh.dim_route, wh.dim_stop, j.zone, stored=True)
    incremental.merge_fact_partitions(path, batch_fact, located_by="scheduled_departure")
    return sinks.read_fact(j.spark, path)


# ---------------------------------------------------------------- history, rules, intermediate steps
@query("recent_history")
def _q_history(j: Job) -> DataFrame:
    return reporting.recent_history(j.observations, j.stops, j.routes, S.HISTORY_LIMIT, j.zone)


@query("scalar_rules")
def _q_rules(j: Job) -> DataFrame:
    return rules.scalar_rules(j.observations, j.zone)


@query("usable_filter")
def _q_usable(j: Job) -> DataFrame:
    return warehouse.usable_filter(j.observations)


@query("fact_derive")
def _q_derive(j: Job) -> DataFrame:
    return warehouse.fact_derive(warehouse.usable_filter(j.observations), j.zone)


@query("join_fact_route")
def _q_join_route(j: Job) -> DataFrame:
    derived = warehouse.fact_derive(warehouse.usable_filter(j.observations), j.zone)
    return warehouse.join_fact_route(derived, j.wh.dim_route)


@query("star_join")
def _q_star(j: Job) -> DataFrame:
    """J3 without the route scope: every route of the fact."""
    return warehouse.dashboard_view(j.wh, route_numbers=None)


@query("tram_scope_from_id")
def _q_tram_scope(j: Job) -> DataFrame:
    return snapshot.snapshot_input(j.raw, j.stops, j.zone)


@query("join_fact_stop")
def _q_join_stop(j: Job) -> DataFrame:
    """J1 + J2 before the final keep list: the helper ids are still there."""
    derived = warehouse.fact_derive(warehouse.usable_filter(j.observations), j.zone)
    return warehouse.join_fact_stop(warehouse.join_fact_route(derived, j.wh.dim_route), j.wh.dim_stop)


@query("history_join")
def _q_history_join(j: Job) -> DataFrame:
    """J7 + F19 over the whole history (the page keeps the latest 50)."""
    return reporting.history_format(reporting.history_join(j.observations, j.stops, j.routes), j.zone)


@query("dim_resolution")
def _q_dim_resolution(j: Job) -> DataFrame:
    return quality.dim_resolution(j.wh)


@query("statistics_gate")
def _q_gate(j: Job) -> DataFrame:
    return reporting.statistics_gate(j.view, snapshot.snapshot_input(j.raw, j.stops, j.zone))


@query("kpi_display")
def _q_kpi_display(j: Job) -> DataFrame:
    return reporting.kpi_display(j.view)


@query("run_scoped_ids")
def _q_run_scoped(j: Job) -> DataFrame:
    """F13 variant for observations without a collection time: run and index join the key."""
    return j.observations.select("observation_id", identity.run_scoped_observation_id(
        F.col("collection_run_id"), F.col("trip_id"), F.col("stop_id"), F.col("scheduled_departure"),
        F.col("stop_sequence")).alias("run_scoped_id"))


@query("source_audit")
def _q_source_audit(j: Job) -> DataFrame:
    return quality.source_audit(j.observations, j.routes, j.stops)


@query("warehouse_checks")
def _q_warehouse_checks(j: Job) -> DataFrame:
    return quality.warehouse_checks(j.spark, j.observations, j.wh)


def _operational_store(j: Job) -> str:
    """Routes and stops as the collector leaves them (payload upserts), written as the store."""
    root = scratch_path(j.spark, "transit_data")
    entities = dimension(ingest.parsed_entities(_parsed(j)))
    ingest.upsert_entities(j.routes, ingest.route_rows(entities)).write.parquet(f"{root}/routes")
    ingest.upsert_entities(j.stops, ingest.stop_rows(entities)).write.parquet(f"{root}/stops")
    return root


@query("extract_routes")
def _q_extract_routes(j: Job) -> DataFrame:
    return extract.extract_table(j.spark, extract.parquet_reader(_operational_store(j)), "routes", scratch_path(j.spark, "raw"))


@query("extract_stops")
def _q_extract_stops(j: Job) -> DataFrame:
    return extract.extract_table(j.spark, extract.parquet_reader(_operational_store(j)), "stops", scratch_path(j.spark, "raw"))


@query("looker_metrics_date_range")
def _q_looker_dates(j: Job) -> DataFrame:
    """C14 with a date filter over the stored, date-partitioned fact (partition pruning)."""
    path = scratch_path(j.spark, "fact-looker")
    sinks.write_fact_partitioned(j.wh.fact, path)
    stored = warehouse.Warehouse(j.wh.dim_date, j.wh.dim_route, j.wh.dim_stop, sinks.read_fact(j.spark, path), j.zone)
    view = warehouse.dashboard_view(stored, date_from="2024-03-25", date_to="2024-04-07")
    return reporting.looker_metrics(view, by=("route_number", "calendar_date", "delay_category"))


@query("relative_bar_ranking")
def _q_bar_ranking(j: Job) -> DataFrame:
    return reporting.relative_bar(reporting.stop_delay_ranking(j.view), "avg_delay_minutes")


@query("relative_bar_hourly")
def _q_bar_hourly(j: Job) -> DataFrame:
    return reporting.relative_bar(reporting.hourly_merge(reporting.hourly_delay_trend(j.view)), "avg_delay_minutes")


@query("relative_bar_category")
def _q_bar_category(j: Job) -> DataFrame:
    return reporting.relative_bar(reporting.delay_category_breakdown(j.view), "observation_count")
