"""First wins, last wins, insert-ignore, merge idempotence."""

import datetime as dt

from delaystar.operators import dedup, incremental

COLS = ("observation_id string, duplicate_key string, created_at timestamp_ntz, tie_1 bigint, tie_2 bigint, "
        "tie_3 double, tie_4 double, delay_seconds bigint, collection_run_id string, route_id string, stop_id string")


def _df(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_insert_ignore_skips_stored_key(spark):
    t = dt.datetime(2026, 5, 16, 12, 0)
    target = _df(spark, [("o1", "K", t, 1, 1, 1.0, 1.0, 10, "R", "r", "s")])
    batch = _df(spark, [("o2", "K", t, 2, 1, 1.0, 1.0, 20, "R", "r", "s")])
    assert dedup.insert_ignore(target, batch).count() == 0
    s = dedup.save_summary(batch, dedup.insert_ignore(target, batch)).first()
    assert (s.delay_observations_saved, s.duplicate_observations_skipped) == (0, 1)


def test_first_wins_and_last_wins(spark):
    t = dt.datetime(2026, 5, 16, 12, 0)
    rows = [("o1", "K", t, 2, 0, 0.0, 0.0, 1, "R", "r", "s"),
            ("o1", "K", t, 1, 0, 0.0, 0.0, 2, "R", "r", "s"),
            ("o1", "K", None, 0, 0, 0.0, 0.0, 3, "R", "r", "s"),
            ("o1", "K", t + dt.timedelta(seconds=1), 0, 0, 0.0, 0.0, 4, "R", "r", "s")]
    df = _df(spark, rows)
    assert dedup.dedup_first_by_key(df).first().delay_seconds == 2
    assert dedup.dedup_latest_by_id(df).first().delay_seconds == 4


def test_merge_update_insert_and_rerun(spark):
    t = dt.datetime(2026, 5, 16, 12, 0)
    target = _df(spark, [("o1", "K1", t, 1, 1, 1.0, 1.0, 10, "R", "r", "s"),
                         ("o2", "K2", t, 1, 1, 1.0, 1.0, 20, "R", "r", "s")])
    batch = _df(spark, [("o2", "K2", t, 1, 1, 1.0, 1.0, 25, "R", "r", "s"),
                        ("o3", "K3", t, 1, 1, 1.0, 1.0, 30, "R", "r", "s")])
    once = incremental.merge_raw(target, batch)
    twice = incremental.merge_raw(once, batch)
    assert sorted((r.observation_id, r.delay_seconds) for r in once.collect()) == [("o1", 10), ("o2", 25), ("o3", 30)]
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_upsert_last_write_wins(spark):
    from delaystar.operators import ingest

    t = dt.datetime(2026, 5, 16, 12, 0)
    target = spark.createDataFrame([("R1", "4", "TRAM")], "id string, short_name string, route_type string")
    rows = [("R1", "4A", "TRAM", t, "p1", 0), ("R1", "4B", "TRAM", t, "p1", 1), ("R2", "6", "TRAM", t, "p0", 0)]
    batch = spark.createDataFrame(rows, "id string, short_name string, route_type string, fetched_at timestamp_ntz, "
                                        "payload_id string, position int")
    got = sorted(tuple(r) for r in ingest.upsert_entities(target, batch).collect())
    assert got == [("R1", "4B", "TRAM"), ("R2", "6", "TRAM")]
