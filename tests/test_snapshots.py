"""Write, audit, publish: sets of tables, their index, digests, failures and conflicts."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from delaystar.operators import dedup, incremental, partition_checks, quality, reporting, warehouse
from delaystar.plans.registry import Job
from delaystar.session import dimension, scratch_path
from delaystar.sources import sinks, snapshots

from .conftest import SMALL_SF

FACT_SCHEMA = (
    "source_observation_id string, date_key bigint, route_key string, stop_key string, collection_run_id string, trip_id string, "
    "headsign string, direction_id string, stop_sequence bigint, observed_at timestamp_ntz, scheduled_departure timestamp_ntz, "
    "predicted_departure timestamp_ntz, delay_seconds bigint, delay_minutes double, delay_category string, "
    "source_delay_category string, time_period string, observation_count bigint"
)


@pytest.fixture(scope="module")
def loaded(spark):
    """(job, root, raw): a published warehouse of the known routes' observations before June 29."""
    j = Job(spark, SMALL_SF)
    raw = dimension(j.observations.filter("route_id <> 'R_9999' AND created_at >= TIMESTAMP_NTZ '2024-05-15 00:00:00'"))
    history = raw.filter("created_at < TIMESTAMP_NTZ '2024-06-29 00:00:00'")
    return j, lambda: _load(spark, j, history), raw


def _load(spark, j, history):
    root = scratch_path(spark, "set")
    incremental.initial_load(root, warehouse.build_warehouse(history, j.routes, j.stops, j.zone), history)
    return root


def batch_of(raw, extra=5):
    late = raw.filter("created_at BETWEEN TIMESTAMP_NTZ '2024-06-28 00:00:00' AND TIMESTAMP_NTZ '2024-06-30 00:00:00'")
    return late.withColumn("delay_seconds", F.col("delay_seconds") + extra)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def test_published_cycle_equals_a_whole_merge_and_rewrites_touched_days_only(spark, loaded):
    j, load, raw = loaded
    root = load()
    before = snapshots.published(spark, root)
    out = incremental.run_cycle(root, batch_of(raw), j.routes, j.stops, "c1")
    after = snapshots.published(spark, root)
    assert out.succeeded and after.number == before.number + 1 and [r.status for r in out.log.collect()] == ["success"]

    wh = incremental.warehouse_of(before)
    wh = dataclasses.replace(wh, fact=wh.fact.drop("observed_date"))
    whole = incremental.incremental_cycle(wh, before.table("raw"), incremental._raw_with_day(batch_of(raw)), j.routes, j.stops)
    assert rows(after.table("raw")) == rows(whole.raw)
    assert rows(after.table("dim_date")) == rows(whole.dim_date)
    assert rows(after.table("fact").drop("observed_date")) == rows(whole.fact.select(*warehouse.FACT_COLUMNS))
    changed = {p for t, p in after.changed_since(before) if t == "fact"}
    assert changed and all("2024-06-27" <= p <= "2024-06-30" for p in changed)
    assert len(after.of("fact")) > 40
    # the former set stays readable by its number
    assert rows(snapshots.published(spark, root, before.number).table("fact")) == rows(before.table("fact"))


def test_a_failed_audit_and_a_killed_writer_leave_the_former_set(spark, loaded, monkeypatch):
    j, load, raw = loaded
    root = load()
    before = {t: rows(snapshots.published(spark, root).table(t)) for t in ("raw", "fact", *incremental.DIMENSIONS)}

    def served():
        now = snapshots.published(spark, root)
        return now.number == 1 and {t: rows(now.table(t)) for t in before} == before

    known = j.routes.filter("id <> 'R_3040'")  # rows of this route are lost in the join
    out = incremental.run_cycle(root, batch_of(raw), known, j.stops, "lossy")
    assert not out.succeeded and served()
    stage, calls = snapshots.stage, []

    def dying(df, root, table, version, **kw):
        if len(calls) == 2:
            raise RuntimeError("killed between two tables")
        calls.append(table)
        return stage(df, root, table, version, **kw)

    monkeypatch.setattr(snapshots, "stage", dying)
    with pytest.raises(RuntimeError, match="killed"):
        incremental.run_cycle(root, batch_of(raw), j.routes, j.stops, "killed")
    assert len(calls) == 2 and served()
    monkeypatch.setattr(snapshots, "stage", stage)
    publish = snapshots.publish
    monkeypatch.setattr(snapshots, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed before the commit")))
    with pytest.raises(RuntimeError, match="commit"):
        incremental.run_cycle(root, batch_of(raw), j.routes, j.stops, "again")
    assert served()
    monkeypatch.setattr(snapshots, "publish", publish)
    assert incremental.run_cycle(root, batch_of(raw), j.routes, j.stops, "again").succeeded
    log = {r.cycle_id: r.status for r in spark.read.schema(sinks.CONTROL_SCHEMA).parquet(f"{root}/etl_control").collect()}
    assert log == {"lossy": "failed", "again": "success"}


def test_a_rerun_changes_no_partition(spark, loaded):
    j, load, raw = loaded
    root = load()
    first = incremental.run_cycle(root, batch_of(raw), j.routes, j.stops, "one").tables
    again = incremental.run_cycle(root, batch_of(raw), j.routes, j.stops, "two")
    assert again.succeeded and again.tables.number == first.number + 1
    assert again.tables.changed_since(first) == set()
    other = incremental.run_cycle(root, batch_of(raw, extra=7), j.routes, j.stops, "three").tables
    assert {t for t, _ in other.changed_since(first)} == {"raw", "fact", "checks"}


def test_kept_checks_equal_the_full_ones_and_read_touched_days_only(spark, loaded, monkeypatch):
    """Three cycles over a set that has issues of many kinds."""
    j, _, raw = loaded
    history = raw.filter("created_at < TIMESTAMP_NTZ '2024-06-25 00:00:00'")
    root = scratch_path(spark, "checked")
    wh = warehouse.build_warehouse(history, j.routes, j.stops, j.zone)
    twice = wh.fact.unionByName(wh.fact.where("route_key = 'R_3040' AND delay_seconds % 7 = 0"))  # repeated ids
    odd = twice.withColumn("time_period", F.when(F.col("delay_seconds") % 11 == 0, "other period").otherwise(F.col("time_period")))
    odd = odd.withColumn("stop_key", F.when(F.to_date("observed_at") == "2024-05-20", "S_new").otherwise(F.col("stop_key")))
    odd = odd.withColumn("source_observation_id", F.when(F.col("delay_seconds") % 17 == 0, F.lit(None)).otherwise(F.col("source_observation_id")))
    wh = dataclasses.replace(wh, fact=dimension(odd))
    parent = incremental.initial_load(root, wh, history)
    opened = []
    table = snapshots.TableSet.table

    def noted(self, name, partitions=None):
        if name in ("raw", "fact") and self.number is None:
            opened.append((name, None if partitions is None else len(set(partitions))))
        return table(self, name, partitions)

    stops = [j.stops, j.stops.unionByName(spark.createDataFrame([("S_new", "New", 1.0, 2.0)], j.stops.schema)), j.stops.where("id <> 'S_3'")]
    for k, stop_table in enumerate(stops):
        day = dt.datetime(2024, 6, 26 + k)
        batch = raw.filter((F.col("created_at") >= F.lit(day - dt.timedelta(days=2)).cast("timestamp_ntz")) & (F.col("created_at") < F.lit(day).cast("timestamp_ntz")))
        proposed = incremental.propose_cycle(parent, batch, j.routes, stop_table, f"v{k}")
        monkeypatch.setattr(snapshots.TableSet, "table", noted)
        checks, proposed = partition_checks.stage_checks(proposed, parent, f"v{k}")
        monkeypatch.setattr(snapshots.TableSet, "table", table)
        full = quality.warehouse_checks(spark, proposed.table("raw"), incremental.warehouse_of(proposed))
        assert checks.columns == full.columns
        got = checks.first().asDict()
        assert got == full.first().asDict(), k
        assert got["duplicate_fact_ids"] and got["local_time_period_mismatch"] and got["missing_observation_id"]
        assert all(n is not None for _, n in opened)
        if k == 0:  # the dimensions did not change: three or four days of each table are read
            assert max(n for _, n in opened) <= 6 < 20 < len(proposed.of("fact"))
        parent = snapshots.publish(proposed, parent, f"v{k}")


def test_latest_rows_open_the_newest_days_only(spark, loaded, monkeypatch):
    j, load, raw = loaded
    tables = snapshots.published(spark, load())
    opened = []
    table = snapshots.TableSet.table
    monkeypatch.setattr(snapshots.TableSet, "table", lambda self, name, p=None: (opened.append(len(p)), table(self, name, p))[1])
    named = lambda rows: reporting.history_join(rows, j.stops, j.routes)
    got = snapshots.newest_rows(tables, "raw", "created_at", 50, named, ties=("observation_id",))
    history = raw.filter("created_at < TIMESTAMP_NTZ '2024-06-29 00:00:00'")
    want = named(history).orderBy(F.col("created_at").desc_nulls_last(), "observation_id").limit(50)
    assert [r.observation_id for r in got.collect()] == [r.observation_id for r in want.collect()]
    assert max(opened) <= 6 < 40 < len(tables.of("raw"))
    # a filter that leaves few rows opens more, down to all of them; ties and missing times as before
    for condition, limit in (("stop_id = 'S_7' AND delay_seconds > 300", 5), ("stop_id = 'none'", 3), ("true", 10**6)):
        got = snapshots.newest_rows(tables, "raw", "created_at", limit, lambda rows: rows.where(condition), ties=("observation_id",))  # noqa: B023
        want = history.where(condition).orderBy(F.col("created_at").desc_nulls_last(), "observation_id").limit(limit)
        assert [r.observation_id for r in got.collect()] == [r.observation_id for r in want.collect()]


def test_the_second_of_two_writers_is_told(spark):
    root = scratch_path(spark, "two")
    parent = snapshots.published(spark, root)
    assert parent.number == 0 and parent.entries == ()
    one = parent.with_staged(snapshots.stage(spark.range(3), root, "t", "a"))
    two = parent.with_staged(snapshots.stage(spark.range(5), root, "t", "b"))
    snapshots.publish(one, parent, "a")
    with pytest.raises(snapshots.PublishConflict):
        snapshots.publish(two, parent, "b")
    assert snapshots.published(spark, root).table("t").count() == 3
    # both saw the parent as the newest: the first line in order counts
    manifest = f"{1:020d}-0"
    spark.createDataFrame([tuple(e) for e in two.entries], snapshots.ENTRY_SCHEMA).coalesce(1).write.parquet(f"{root}/_manifests/{manifest}")
    spark.createDataFrame([(f"{1:020d} {manifest}",)], "line string").coalesce(1).write.mode("append").text(f"{root}/_COMMITS")
    assert snapshots.published(spark, root).table("t").count() == 5
    with pytest.raises(FileNotFoundError):
        snapshots.published(spark, root, 7)


def fact_row(i, day, minute=0, delay=10, moved=0):
    t = dt.datetime(2023, 1, 1) + dt.timedelta(days=day, minutes=minute)
    seen = t + dt.timedelta(days=moved)
    return (f"o{i}", int(f"{seen:%Y%m%d}"), "R", "S", "r", "t", "h", "0", 1, seen, t, t, delay, delay / 60.0, "on time", "on_time", "other period", 1)


def test_merge_of_two_rows_into_400_dates_opens_the_dates_that_can_hold_them(spark):
    stored = spark.createDataFrame([fact_row(i, i % 400, minute=i % 7) for i in range(1200)], FACT_SCHEMA)
    # one row moves to the next day, one only changes its delay
    batch = spark.createDataFrame([fact_row(17, 17, 3, 99, moved=1), fact_row(250, 250, 5, 77)], FACT_SCHEMA)
    want = rows(dedup.merge_by_id(stored, batch, "source_observation_id"))
    root = scratch_path(spark, "index")
    table = incremental._fact_with_day(stored)
    staged = snapshots.stage(table, root, "fact", "v1", by="observed_date", order=incremental.FACT_ORDER, located_by="scheduled_departure")
    loaded = snapshots.empty_set(spark, root).with_staged(staged)
    days = loaded.can_hold("fact", snapshots.days_of(batch, "scheduled_departure"))
    assert len(loaded.of("fact")) == 400 and days == {"2023-01-18", "2023-09-08"}
    opened = loaded.table("fact", days).inputFiles()
    assert {f.split("observed_date=")[1].split("/")[0] for f in opened} == days and len(opened) < len(loaded.table("fact").inputFiles()) / 50

    path = scratch_path(spark, "index-path")
    sinks.write_fact_partitioned(stored, path, located_by="scheduled_departure")
    found = sinks.dates_located(spark, path, batch, "scheduled_departure")
    assert sorted(str(r[0]) for r in found.collect()) == sorted(days)
    incremental.merge_fact_partitions(path, batch, located_by="scheduled_departure")
    assert rows(sinks.read_fact(spark, path).select(*stored.columns)) == want
    # moved back: the index lists the day that the row moved to
    back = spark.createDataFrame([fact_row(17, 17, 3, 55)], FACT_SCHEMA)
    incremental.merge_fact_partitions(path, back, located_by="scheduled_departure")
    got = [r for r in sinks.read_fact(spark, path).where("source_observation_id = 'o17'").collect()]
    assert [(str(r.observed_date), r.delay_seconds) for r in got] == [("2023-01-18", 55)]


def test_null_dates_are_merged_like_others(spark):
    """A fact without a time of observation, which the fact build never makes, is not overwritten by a batch."""
    null = lambda i, delay: (*fact_row(i, 3, delay=delay)[:9], None, *fact_row(i, 3, delay=delay)[10:])
    path = scratch_path(spark, "nulls")
    sinks.write_fact_partitioned(spark.createDataFrame([null(1, 10), null(2, 20), fact_row(3, 3)], FACT_SCHEMA), path)
    incremental.merge_fact_partitions(path, spark.createDataFrame([null(2, 99), fact_row(4, 3)], FACT_SCHEMA))
    got = {r.source_observation_id: (r.observed_date is None, r.delay_seconds) for r in sinks.read_fact(spark, path).collect()}
    assert got == {"o1": (True, 10), "o2": (True, 99), "o3": (False, 10), "o4": (False, 10)}


def test_an_emptied_day_leaves_the_set(spark):
    root = scratch_path(spark, "emptied")
    table = incremental._fact_with_day(spark.createDataFrame([fact_row(1, 1), fact_row(2, 2)], FACT_SCHEMA))
    first = snapshots.empty_set(spark, root).with_staged(snapshots.stage(table, root, "fact", "a", by="observed_date"))
    moved = incremental._fact_with_day(spark.createDataFrame([fact_row(2, 2, moved=-1), fact_row(1, 1)], FACT_SCHEMA))
    second = first.with_staged(snapshots.stage(moved, root, "fact", "b", by="observed_date"), {"fact": {"2023-01-02", "2023-01-03"}})
    assert sorted(second.of("fact")) == ["2023-01-02"] and second.table("fact").count() == 2
    assert second.table("fact", []).count() == 0
    with pytest.raises(KeyError):
        second.table("none")


def test_staged_versions_are_written_with_zstd(spark, tmp_path):
    """A cycle writes the history and the fact whole, so what it stages is written as densely as a dimension."""
    rows = spark.range(200).selectExpr("id", "date_add(date'2024-01-01', cast(id % 3 as int)) AS day")
    staged = snapshots.stage(rows, str(tmp_path), "t", "v", by="day", order=("id",))
    staged += snapshots.stage(rows, str(tmp_path), "whole", "v")
    files = [str(p) for p in tmp_path.rglob("*.parquet") if p.is_file()]
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    tables = snapshots.empty_set(spark, str(tmp_path)).with_staged(staged)
    want = sorted(map(tuple, rows.collect()))
    assert [sorted(map(tuple, tables.table(t).select("id", "day").collect())) for t in ("t", "whole")] == [want, want]
