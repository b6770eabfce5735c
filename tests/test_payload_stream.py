"""Payload files as a stream with quarantine (S1, I8), and overlap rows that are never lost."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from delaystar.operators import ingest
from delaystar.plans.registry import Job
from delaystar.session import dimension, scratch_path
from delaystar.sources import payloads
from delaystar.streaming import collector, payload_stream

from .conftest import SMALL_SF
from .test_ingest import _departures

TABLES = tuple(payload_stream.SCHEMAS)


@pytest.fixture(scope="module")
def landed(spark):
    j = Job(spark, SMALL_SF)
    landing = scratch_path(spark, "payloads")
    rows = dimension(payloads.departure_payloads(j.raw, j.routes, j.stops))
    payload_stream.land_payload_files(rows, landing)
    return j, rows, landing


def store_rows(spark, root):
    return {t: sorted((tuple(r) for r in payload_stream.read_store(spark, root, t).collect()), key=repr) for t in TABLES}


def test_store_equals_the_batch_collection_and_a_replay_changes_nothing(spark, landed):
    j, rows, landing = landed
    root = scratch_path(spark, "store")
    payload_stream.stream_payloads(spark, landing, root, scratch_path(spark, "ckpt"))
    first = store_rows(spark, root)

    scanned = ingest.scan_payloads(rows)
    parsed = ingest.parse_departures(scanned, 4)
    observations = ingest.parsed_observations(parsed)
    accepted = ingest.collect_accepted(observations.limit(0), observations)
    names = payload_stream.read_store(spark, root, "delay_observations").columns
    assert first["delay_observations"] == sorted((tuple(r) for r in accepted.select(*names).collect()), key=repr)
    routes = ingest.upsert_entities(j.routes.limit(0), ingest.parsed_routes(parsed))
    assert first["routes"] == sorted((tuple(r) for r in routes.collect()), key=repr)
    # nothing is dropped: each payload has a run or a quarantine row
    assert len(first["collection_runs"]) + len(first["quarantine"]) == rows.count()
    assert {r[4] for r in first["quarantine"]} == {"invalid JSON", "status ERROR: upstream unavailable"}

    # a lost checkpoint replays every file, in other micro-batches too
    payload_stream.stream_payloads(spark, landing, root, scratch_path(spark, "ckpt"))
    assert store_rows(spark, root) == first


def test_small_micro_batches_keep_each_key_once(spark, landed):
    j, rows, landing = landed
    root = scratch_path(spark, "store")
    payload_stream.stream_payloads(spark, landing, root, scratch_path(spark, "ckpt"), files_per_trigger=3)
    store = payload_stream.read_store(spark, root, "delay_observations")
    keys = ingest.parsed_observations(ingest.parse_departures(ingest.scan_payloads(rows), 4)).select("duplicate_key").distinct()
    assert store.count() == keys.count() == store.select("duplicate_key").distinct().count()
    runs = payload_stream.read_store(spark, root, "collection_runs")
    assert runs.agg(F.sum("records_saved")).first()[0] == store.count()


def test_an_interrupted_batch_is_not_seen(spark, landed, monkeypatch):
    _, _, landing = landed
    root, checkpoint = scratch_path(spark, "store"), scratch_path(spark, "ckpt")
    commit = payload_stream.commit_batch
    monkeypatch.setattr(payload_stream, "commit_batch", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(Exception, match="killed"):
        payload_stream.stream_payloads(spark, landing, root, checkpoint)
    assert all(not rows for rows in store_rows(spark, root).values())
    monkeypatch.setattr(payload_stream, "commit_batch", commit)
    payload_stream.stream_payloads(spark, landing, root, checkpoint)  # the same checkpoint: the batch is replayed
    whole = scratch_path(spark, "store")
    payload_stream.stream_payloads(spark, landing, whole, scratch_path(spark, "ckpt"))
    assert store_rows(spark, root) == store_rows(spark, whole)


def test_bad_files_land_in_quarantine_with_their_text(spark):
    good = {"payload_id": "p1", "collection_run_id": "RUN", "stop_id": "STOP_1", "fetched_at": "2026-05-16T14:00:00",
            "body": json.dumps(_departures("array"))}
    lines = [json.dumps(good), "not an envelope", json.dumps({"collection_run_id": "RUN", "body": "{}"}),
             json.dumps(good | {"payload_id": "p2", "body": "{cut"}), json.dumps(good | {"payload_id": "p3", "body": '{"status": "DOWN"}'}),
             json.dumps(good | {"payload_id": "p4"} | {"body": None})]
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "store")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(landing)
    payload_stream.stream_payloads(spark, landing, root, scratch_path(spark, "ckpt"))
    got = {(r.payload_id, r.error_message, r.body) for r in payload_stream.read_store(spark, root, "quarantine").collect()}
    bad = payload_stream.BAD_ENVELOPE
    assert got == {(None, bad, lines[1]), (None, bad, lines[2]), ("p2", "invalid JSON", "{cut"),
                   ("p3", "status DOWN: ", '{"status": "DOWN"}'), ("p4", bad, lines[5])}
    assert [r.id for r in payload_stream.read_store(spark, root, "collection_runs").collect()] == ["p1"]
    assert {r.file is not None for r in payload_stream.read_store(spark, root, "quarantine").collect()} == {True}


def test_whole_files_carry_their_names(spark, tmp_path):
    for run, stop, name, body in (("C1", "STOP_1", "a.json", json.dumps(_departures("object"), indent=1)), ("C1", "STOP 2", "b.json", "oops\n{")):
        (tmp_path / run / stop).mkdir(parents=True, exist_ok=True)
        (tmp_path / run / stop / name).write_text(body)
    root = scratch_path(spark, "store")
    payload_stream.stream_payloads(spark, str(tmp_path), root, scratch_path(spark, "ckpt"), whole_files=True)
    runs = payload_stream.read_store(spark, root, "collection_runs").collect()
    assert [(r.id, r.records_saved) for r in runs] == [("a", 3)] and runs[0].started_at is not None
    assert [(s.id, s.name) for s in payload_stream.read_store(spark, root, "stops").collect()] == [("STOP_1", "North Gate")]
    bad = payload_stream.read_store(spark, root, "quarantine").collect()
    assert [(r.payload_id, r.collection_run_id, r.stop_id, r.body) for r in bad] == [("b", "C1", "STOP 2", "oops\n{")]


def test_accepted_duplicate_and_late_rows_add_up_on_events(spark):
    events = spark.read.parquet(f"{SMALL_SF}/events.parquet")
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    held_back = (F.col("ts") < at("2024-01-05 00:00:00")) & (F.col("event_id") % 7 == 0)
    resent = (F.col("ts") >= at("2024-01-19 12:00:00")) & (F.col("ts") < at("2024-01-20 00:00:00"))
    landing = scratch_path(spark, "events")
    parts = [events.filter((F.col("ts") < at("2024-01-10 00:00:00")) & ~held_back),
             events.filter((F.col("ts") >= at("2024-01-10 00:00:00")) & (F.col("ts") < at("2024-01-20 00:00:00"))),
             events.filter(F.col("ts") >= at("2024-01-20 00:00:00")).unionByName(events.filter(held_back)).unionByName(events.filter(resent))]
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{landing}/batch-{i:04d}")
    root = scratch_path(spark, "overlap")
    run = lambda: collector.stream_overlap(spark, f"{landing}/*", events.schema, root, scratch_path(spark, "ckpt"),
                                           keys=("event_id",), ts_ntz="ts", files_per_trigger=1)
    counts = sorted(map(tuple, run().drop("newest").collect()), key=lambda r: r[-1])
    n_late, n_resent = events.filter(held_back).count(), events.filter(resent).count()
    assert n_late and n_resent and len(counts) == 3
    assert all(i == a + d + x for i, a, d, x, _ in counts)
    assert [r[2] for r in counts] == [0, 0, n_resent] and [r[3] for r in counts] == [0, 0, n_late]
    late = collector.overlap_rows(spark, root, collector.LATE, events.schema)
    accepted = collector.overlap_rows(spark, root, collector.ACCEPTED, events.schema)
    assert late.exceptAll(events.filter(held_back)).isEmpty() and late.count() == n_late
    assert accepted.unionByName(late).exceptAll(events).isEmpty() and accepted.count() + n_late == events.count()
    assert sorted(map(tuple, run().drop("newest").collect()), key=lambda r: r[-1]) == counts  # a replay


def test_late_rows_reach_the_exact_store(spark):
    j = Job(spark, SMALL_SF)
    raw = dimension(j.raw.where("scheduled_departure BETWEEN TIMESTAMP_NTZ '2024-05-20 00:00:00' AND TIMESTAMP_NTZ '2024-06-10 00:00:00'"))
    landing = scratch_path(spark, "landing")
    cut = dt.datetime(2024, 6, 1)
    late = "created_at < TIMESTAMP_NTZ '2024-05-25 00:00:00' AND stop_sequence = 2"
    for i, part in enumerate([raw.where(f"created_at < TIMESTAMP_NTZ '{cut}' AND NOT ({late})"),
                              raw.where(f"(created_at >= TIMESTAMP_NTZ '{cut}' OR created_at IS NULL)"), raw.where(late)]):
        part.coalesce(1).write.parquet(f"{landing}/part-{i}")
    store = scratch_path(spark, "store")
    counts = collector.stream_overlap(spark, f"{landing}/*", raw.schema, scratch_path(spark, "overlap"), scratch_path(spark, "ckpt"),
                                      files_per_trigger=1, store=store)
    total = counts.agg(*[F.sum(c) for c in ("input_rows", "accepted", "duplicates", "late")]).first()
    assert total[0] == raw.count() == sum(total[1:]) and total[3] == raw.where(late).count()
    keys = lambda df: {r[0] for r in df.select("duplicate_key").collect()}
    stored = spark.read.parquet(store)
    assert keys(stored) == keys(raw) and stored.count() == len(keys(raw))
