"""Scalar rules: boundaries and exact texts."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from delaystar.functions import columns as C
from delaystar.functions import identity


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_operational_category_boundaries(spark):
    secs = [-61, -60, 60, 61, 180, 181, 360, 361, None]
    got = one(spark, C.operational_category("s"), [(s,) for s in secs], "s bigint")
    assert got == ["early", "on_time", "on_time", "minor_delay", "minor_delay", "medium_delay", "medium_delay",
                   "major_delay", None]


def test_warehouse_category_boundaries(spark):
    got = one(spark, C.warehouse_category("s"), [(s,) for s in [0, 60, 61, 180, 181, 300, 301]], "s bigint")
    assert got == ["on time", "on time", "minor delay", "minor delay", "significant delay", "significant delay",
                   "severe delay"]


def test_time_period_inclusive(spark):
    got = one(spark, C.time_period("h"), [(h,) for h in [5, 6, 9, 10, 14, 15, 18, 19]], "h int")
    assert got == ["other period", "morning peak", "morning peak", "other period", "other period",
                   "afternoon peak", "afternoon peak", "other period"]


def test_duplicate_key_text(spark):
    rows = [("BKK_TRIP_1", "BKK_STOP_1", dt.datetime(2026, 5, 16, 14, 5))]
    df = spark.createDataFrame(rows, "t string, s string, ts timestamp_ntz")
    got = df.select(identity.duplicate_key(F.col("t"), F.col("s"), F.col("ts"))).first()[0]
    assert got == "BKK_TRIP_1|BKK_STOP_1|2026-05-16T14:05:00+00:00"


def test_observation_id_is_uuid5_and_stable(spark):
    key = "BKK_TRIP_1|BKK_STOP_1|2026-05-16T14:05:00+00:00"
    got = one(spark, identity.uuid5(F.col("k")), [(key,), (key,)], "k string")
    assert got[0] == got[1] == str(uuid.uuid5(uuid.NAMESPACE_URL, key))


def test_delay_seconds_truncates_toward_zero(spark):
    base = dt.datetime(2024, 5, 1, 12, 0, 0)
    rows = [(base, base + dt.timedelta(seconds=120.9)), (base, base - dt.timedelta(seconds=120.9)),
            (base, None)]
    df = spark.createDataFrame(rows, "s timestamp_ntz, p timestamp_ntz")
    got = [r[0] for r in df.select(C.delay_seconds_between("s", C.prediction_fallback("p", "s"))).collect()]
    assert got == [120, -120, 0]


@pytest.mark.parametrize("route_id,expected", [
    ("BKK_3040", "4"), ("3040", "4"), ("4", "4"), ("X_13040", "4"), ("BKK_3060", "6"), ("6", "6"),
    ("R_0070", ""), ("tram-4", "4"), ("line 46", ""), ("line 6", "6"), ("R_14", ""), ("", ""),
])
def test_route_number_from_id(spark, route_id, expected):
    assert one(spark, C.route_number_from_id("r"), [(route_id,)], "r string") == [expected]


def test_normalized_headsign(spark):
    rows = [("Ujbuda-kozpont M",), ("Moricz Zsigmond korter M",), (" Újbuda-központ M ",), ("Szell Kalman ter M",),
            ("",), (None,), ("  ",)]
    got = one(spark, C.normalized_headsign("h"), rows, "h string")
    merged = "Újbuda-központ M / Móricz Zsigmond körtér M"
    assert got == [merged, merged, merged, "Szell Kalman ter M", "unknown", "unknown", "unknown"]


def test_display_category(spark):
    rows = [("on_time", 500), ("Major_Delay", 10), ("early", -100), ("medium_delay", 200), ("medium_delay", 340),
            ("minor_delay", 0)]
    got = one(spark, C.display_category("c", "s"), rows, "c string, s bigint")
    assert got == ["on time", "significant delay", "on time", "significant delay", "severe delay", "minor delay"]


def test_local_time_dst_fold_and_history_clock(spark):
    rows = [(dt.datetime(2024, 10, 27, 0, 30),), (dt.datetime(2024, 10, 27, 1, 30),), (dt.datetime(2024, 5, 16, 12, 5),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = [r[0] for r in df.select(C.local_clock("ts")).collect()]
    assert got == ["02:30", "02:30", "14:05"]


def test_date_key_uses_local_date(spark):
    rows = [(dt.datetime(2024, 3, 31, 22, 30),), (dt.datetime(2024, 1, 1, 0, 0),)]
    got = one(spark, C.date_key("ts"), rows, "ts timestamp_ntz")
    assert got == [20240401, 20240101]


def test_rounded_mean_half_up_in_integers(spark):
    # 69 s over 2 rows = 0.575 min -> 0.58 (half up); negative sums round away from zero
    rows = [(69, 2), (-69, 2), (120, 1), (0, 3), (5, 0)]
    got = one(spark, C.rounded_mean("s", "n"), rows, "s bigint, n bigint")
    assert got == [0.58, -0.58, 2.0, 0.0, None]


def test_percent_text(spark):
    got = one(spark, C.percent_text("a", "b"), [(4, 5), (1, 8), (0, 0)], "a bigint, b bigint")
    assert got == ["80.0%", "12.5%", None]


def test_minutes_text_and_target_flag(spark):
    rows = [(2.25,), (3.0,), (0.0,)]
    got = spark.createDataFrame(rows, "m double").select(C.minutes_text("m"), C.kpi_target_flag("m")).collect()
    assert [tuple(r) for r in got] == [("2.25 min", "target-ok"), ("3.00 min", "target-warning"),
                                       ("0.00 min", "target-ok")]
