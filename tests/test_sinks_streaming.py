"""Sinks, control log, streaming jobs and session-zone independence."""

import pytest
from pyspark.sql import functions as F

from delaystar.operators import quality, reporting, warehouse
from delaystar.plans.registry import Job
from delaystar.session import scratch_path
from delaystar.sources import sinks
from delaystar.streaming import collector

from .conftest import SMALL_SF


def test_replace_refuses_partial_batch(spark):
    df = spark.range(3)
    with pytest.raises(sinks.PartialBatchError):
        sinks.replace_table(df, scratch_path(spark, "t"), incremental=True)


def test_replace_switches_versions(spark):
    root = scratch_path(spark, "t")
    v1 = sinks.replace_table(spark.range(3), root)
    v2 = sinks.replace_table(sinks.read_current(spark, root).filter("id > 0"), root)
    assert v1 != v2 and sinks.read_current(spark, root).count() == 2


def test_create_schemas_keeps_existing(spark):
    root = scratch_path(spark, "schemas")
    first = {r.table_name: r.created for r in sinks.create_schemas(spark, root).collect()}
    again = {r.table_name: r.created for r in sinks.create_schemas(spark, root).collect()}
    assert all(first.values()) and not any(again.values())


def test_control_log_never_marks_a_failed_cycle_success(spark):
    j = Job(spark, SMALL_SF)
    path = scratch_path(spark, "ctl")
    known = j.observations.filter("route_id <> 'R_9999'")

    def log(raw, name, **kw):
        wh = warehouse.build_warehouse(raw, j.routes, j.stops, j.zone, **kw)
        return sinks.log_cycle(quality.warehouse_checks(spark, raw, wh), path, name)

    log(known, "good")
    log(j.observations, "rows-lost")  # Q1: the unknown route drops usable rows
    rows = {r.cycle_id: r for r in log(known, "utc-build", fact_zone="UTC").collect()}
    assert {k: r.status for k, r in rows.items()} == {"good": "success", "rows-lost": "failed", "utc-build": "failed"}
    assert rows["good"].issue_count == 0 and rows["rows-lost"].issue_count > 0


def test_a_shared_folder_is_required_outside_local_mode():
    from types import SimpleNamespace

    from delaystar.session import ensure_checkpoint_dir

    conf = SimpleNamespace(get=lambda key, default=None: None)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(cluster)


def test_only_a_missing_path_is_an_empty_store(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"not parquet")
    assert collector._store_slice(spark, str(tmp_path / "none"), None, None) is None
    with pytest.raises(Exception):
        collector._store_slice(spark, str(tmp_path / "broken"), None, None).count()


def test_observations_are_never_read_from_jdbc_in_one_split(spark):
    from delaystar.sources import extract

    with pytest.raises(ValueError, match="bounds"):
        extract.jdbc_reader("jdbc:x", {})(spark, "transit_data.delay_observations")


def test_partitioned_fact_prunes_on_local_dates(spark):
    j = Job(spark, SMALL_SF)
    path = scratch_path(spark, "fact")
    sinks.write_fact_partitioned(j.wh.fact, path)
    df = sinks.fact_for_local_dates(sinks.read_fact(spark, path), "2024-03-30", "2024-04-01", j.zone)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "observed_date" in plan
    local = F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(j.zone), "observed_at"))
    expected = j.wh.fact.filter(local.between("2024-03-30", "2024-04-01")).count()
    assert df.count() == expected


def test_stream_collect_equals_first_wins_store(spark):
    j = Job(spark, SMALL_SF)
    landing = scratch_path(spark, "landing")
    collector.land_observation_files(j.raw, landing)
    store = collector.stream_collect(spark, f"{landing}/*", j.raw.schema, scratch_path(spark, "store"),
                                     scratch_path(spark, "ckpt"))
    cols = j.observations.columns
    assert store.select(*cols).exceptAll(j.observations).count() == 0
    assert j.observations.exceptAll(store.select(*cols)).count() == 0


def test_stream_dedup_within_watermark(spark):
    j = Job(spark, SMALL_SF)
    landing = scratch_path(spark, "landing")
    collector.land_observation_files(j.raw, landing)
    out = collector.stream_dedup_overlap(spark, f"{landing}/*", j.raw.schema, scratch_path(spark, "out"),
                                         scratch_path(spark, "ckpt"))
    assert out.groupBy("duplicate_key").count().filter("count > 1").count() == 0
    # rows without an event time are not late; they pass the dedup like any other
    keys_all = j.raw.select("duplicate_key").distinct().count()
    keys_timed = j.raw.filter("created_at IS NOT NULL").select("duplicate_key").distinct().count()
    assert keys_timed <= out.count() <= keys_all


def test_results_do_not_depend_on_session_zone(spark):
    j = Job(spark, SMALL_SF)
    before = [tuple(r) for r in reporting.hourly_delay_trend(j.view).collect()]
    dates = [tuple(r) for r in j.wh.dim_date.orderBy("date_key").collect()]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        j2 = Job(spark, SMALL_SF)
        assert [tuple(r) for r in reporting.hourly_delay_trend(j2.view).collect()] == before
        assert [tuple(r) for r in j2.wh.dim_date.orderBy("date_key").collect()] == dates
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_text_of_times_in_a_dst_gap_of_the_session_zone(spark):
    """2024-03-10 02:30 does not exist in New York; UTC texts must not shift."""
    import datetime as dt

    from delaystar.functions import columns as C
    from delaystar.functions import identity

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 0),), (dt.datetime(2024, 3, 10, 2, 30, 0, 5000),)],
                                   "ts timestamp_ntz")
        keys = [r[0] for r in df.select(identity.iso_utc(F.col("ts"))).collect()]
        assert keys == ["2024-03-10T02:30:00+00:00", "2024-03-10T02:30:00.005000+00:00"]
        clocks = [r[0] for r in df.select(C.local_clock("ts", "UTC")).collect()]
        assert clocks == ["02:30", "02:30"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_watermark_drops_late_rows_and_duplicates_on_events(spark):
    """events: January 2024, ts never goes back in event_id order.  Late rows are
    made by splitting the file: a few early events arrive only in a later delivery.
    Spark filters late rows against the watermark of the batch before, so the late
    delivery is the third micro-batch."""
    from .conftest import SMALL_SF

    events = spark.read.parquet(f"{SMALL_SF}/events.parquet")

    def at(text):
        return F.lit(text).cast("timestamp_ntz")

    held_back = (F.col("ts") < at("2024-01-05 00:00:00")) & (F.col("event_id") % 7 == 0)
    resent = (F.col("ts") >= at("2024-01-19 12:00:00")) & (F.col("ts") < at("2024-01-20 00:00:00"))
    landing = scratch_path(spark, "events")
    deliveries = [
        events.filter((F.col("ts") < at("2024-01-10 00:00:00")) & ~held_back),
        events.filter((F.col("ts") >= at("2024-01-10 00:00:00")) & (F.col("ts") < at("2024-01-20 00:00:00"))),
        events.filter(F.col("ts") >= at("2024-01-20 00:00:00")).unionByName(events.filter(held_back))
        .unionByName(events.filter(resent)),
    ]
    for i, part in enumerate(deliveries):
        part.coalesce(1).write.parquet(f"{landing}/batch-{i:04d}")
    out = collector.stream_dedup_overlap(spark, f"{landing}/*", events.schema, scratch_path(spark, "out"),
                                         scratch_path(spark, "ckpt"), keys=("event_id",), ts_ntz="ts", files_per_trigger=1)
    late_ids = {r[0] for r in events.filter(held_back).select("event_id").collect()}
    got = out.select("event_id")
    assert events.filter(resent).count() > 0
    assert got.groupBy("event_id").count().filter("count > 1").count() == 0  # re-sent rows deduplicated
    assert late_ids and not ({r[0] for r in got.collect()} & late_ids)       # late rows dropped
    assert got.count() == events.count() - len(late_ids)


def test_event_time_keeps_microseconds_in_any_session_zone(spark):
    import datetime as dt

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 59, 738090),)], "ts timestamp_ntz")
        got = df.select(F.unix_micros(collector.event_time("ts"))).first()[0]
        assert got == int(dt.datetime(2024, 3, 10, 2, 30, 59, 738090, tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_in_place_merge_rewrites_only_touched_dates(spark):
    import datetime as dt
    import glob
    import os

    from delaystar.operators import incremental

    j = Job(spark, SMALL_SF)
    path = scratch_path(spark, "fact")
    sinks.write_fact_partitioned(j.wh.fact, path)

    def files():
        return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/observed_date=*/*.parquet")}

    before = files()
    batch = incremental.overlap_extract(j.raw, dt.datetime(2024, 6, 30)).withColumn(
        "delay_seconds", F.col("delay_seconds") + 5)
    batch_fact = warehouse.build_fact(incremental.batch_dedup(batch), j.wh.dim_route, j.wh.dim_stop, j.zone)
    touched = {str(r[0]) for r in batch_fact.select(F.to_date("observed_at")).distinct().collect()}
    incremental.merge_fact_partitions(path, batch_fact)
    after = files()
    for f, t in before.items():
        day = f.split("observed_date=")[1].split("/")[0]
        if day < min(touched) or day > max(touched):
            assert after.get(f) == t, f  # untouched partitions keep their files
    merged = sinks.read_fact(spark, path)
    assert merged.count() == j.wh.fact.count()
    assert merged.groupBy("source_observation_id").count().filter("count > 1").count() == 0


def test_collector_replay_inserts_nothing_twice(spark):
    j = Job(spark, SMALL_SF)
    landing = scratch_path(spark, "landing")
    collector.land_observation_files(j.raw, landing)
    store = scratch_path(spark, "store")
    first = collector.stream_collect(spark, f"{landing}/*", j.raw.schema, store, scratch_path(spark, "ckpt"))
    n = first.count()
    # a lost checkpoint replays every file against the same store
    again = collector.stream_collect(spark, f"{landing}/*", j.raw.schema, store, scratch_path(spark, "ckpt"))
    assert again.count() == n == j.observations.count()


def test_monitored_stops_literal(spark):
    from delaystar.sources import extract

    df = extract.monitored_stops(spark)
    rows = df.collect()
    assert len(rows) == 20
    assert sum(1 for r in rows if r.stop_name == "Harminckettesek tere ") == 2  # trailing space kept
    assert all(r.route_short_names == ["4", "6"] for r in rows)


def test_in_place_merge_moves_a_row_to_another_day_without_a_stale_copy(spark):
    import datetime as dt

    from delaystar.operators import incremental
    from delaystar.operators.warehouse import FACT_COLUMNS

    cols = ("source_observation_id string, date_key bigint, route_key string, stop_key string, "
            "collection_run_id string, trip_id string, headsign string, direction_id string, stop_sequence bigint, "
            "observed_at timestamp_ntz, scheduled_departure timestamp_ntz, predicted_departure timestamp_ntz, "
            "delay_seconds bigint, delay_minutes double, delay_category string, source_delay_category string, "
            "time_period string, observation_count bigint")

    def row(i, day, delay):
        t = dt.datetime(2024, 6, day, 23, 50)
        return (f"o{i}", 20240600 + day, "R", "S", "r", "t", "h", "0", 1, t, t, t, delay, delay / 60.0,
                "on time", "on_time", "other period", 1)

    stored = spark.createDataFrame([row(1, 27, 10), row(2, 27, 20), row(3, 29, 30)], cols)
    path = scratch_path(spark, "fact")
    sinks.write_fact_partitioned(stored, path)
    # o1 is re-delivered with a later copy on the 28th; o4 is new
    batch = spark.createDataFrame([row(1, 28, 99), row(4, 28, 40)], cols).select(*FACT_COLUMNS)
    incremental.merge_fact_partitions(path, batch)
    got = {r.source_observation_id: (str(r.observed_date), r.delay_seconds) for r in sinks.read_fact(spark, path).collect()}
    assert got == {"o1": ("2024-06-28", 99), "o2": ("2024-06-27", 20), "o3": ("2024-06-29", 30),
                   "o4": ("2024-06-28", 40)}
    # the only row of the 29th moves: its partition must not keep the old copy
    incremental.merge_fact_partitions(path, spark.createDataFrame([row(3, 30, 77)], cols).select(*FACT_COLUMNS))
    got = sorted((r.source_observation_id, str(r.observed_date)) for r in sinks.read_fact(spark, path).collect())
    assert got == [("o1", "2024-06-28"), ("o2", "2024-06-27"), ("o3", "2024-06-30"), ("o4", "2024-06-28")]
