"""Statistics on small hand-made inputs (values from the source system's tests)."""

import datetime as dt

from delaystar.operators import reporting, snapshot
from delaystar.plans.registry import Job

from .conftest import SMALL_SF


def test_hourly_merge_weighted_mean(spark):
    rows = spark.createDataFrame([(0, 1.2, 10), (0, 2.2, 5)],
                                 "observed_hour int, avg_delay_minutes double, observation_count bigint")
    out = reporting.hourly_merge(rows).collect()
    assert len(out) == 24
    assert tuple(out[0]) == (0, 1.53, 15)
    assert all(r.observation_count == 0 and r.avg_delay_minutes == 0.0 for r in out[1:])


def test_hourly_merge_clamps_and_empty(spark):
    rows = spark.createDataFrame([(-3, 1.0, 2), (30, 2.0, -4)],
                                 "observed_hour int, avg_delay_minutes double, observation_count bigint")
    out = {r.observed_hour: r for r in reporting.hourly_merge(rows).collect()}
    assert out[0].observation_count == 2 and out[23].observation_count == 0
    empty = rows.limit(0)
    assert reporting.hourly_merge(empty).count() == 0


def _obs(spark, rows):
    return spark.createDataFrame(rows, (
        "observation_id string, collection_run_id string, route_id string, stop_id string, trip_id string, "
        "headsign string, direction_id string, stop_sequence int, scheduled_departure timestamp_ntz, "
        "predicted_departure timestamp_ntz, created_at timestamp_ntz, delay_seconds bigint, delay_category string"))


def _stops(spark):
    return spark.createDataFrame([("BKK_STOP_1", "Oktogon M", 47.505, 19.063)], "id string, name string, lat double, lon double")


def test_snapshot_headsign_merge_and_ranking(spark):
    t = dt.datetime(2026, 5, 16, 5, 0)
    rows = [
        ("1", "r", "BKK_3040", "BKK_STOP_1", "T1", "Ujbuda-kozpont M", "0", 1, t, t, t, 180, "minor_delay"),
        ("2", "r", "BKK_3040", "BKK_STOP_1", "T2", "Moricz Zsigmond korter M", "0", 1, t, t, t, 180, "minor_delay"),
        ("3", "r", "BKK_3060", "BKK_STOP_1", "T3", "Szell Kalman ter M", "0", 1, t, t, t, 0, "on_time"),
        ("4", "r", "BKK_0070", "BKK_STOP_1", "T4", "Other", "0", 1, t, t, t, 900, "major_delay"),
    ]
    snap = snapshot.snapshot_input(_obs(spark, rows), _stops(spark))
    ranking = snapshot.snap_stop_ranking(snap).collect()
    assert [r.headsign for r in ranking] == ["Újbuda-központ M / Móricz Zsigmond körtér M", "Szell Kalman ter M"]
    assert ranking[0].observation_count == 2 and ranking[0].avg_delay_minutes == 3.0
    assert ranking[0].stop_name == "Oktogon M"


def test_snapshot_period_matrix_uses_scheduled_local_hour(spark):
    morning = dt.datetime(2026, 5, 16, 5, 0)   # 07:00 local
    afternoon = dt.datetime(2026, 5, 16, 13, 0)  # 15:00 local
    rows = [
        ("1", "r", "BKK_3040", "BKK_STOP_1", "T1", "A", "0", 1, morning, morning, morning, 120, "minor_delay"),
        ("2", "r", "BKK_3040", "BKK_STOP_1", "T2", "A", "0", 1, afternoon, afternoon, afternoon, 120, "minor_delay"),
    ]
    snap = snapshot.snapshot_input(_obs(spark, rows), _stops(spark))
    m = {(r.route_number, r.time_period): r.avg_delay_minutes for r in snapshot.snap_time_period_matrix(snap).collect()}
    assert m == {("4", "morning peak"): 2.0, ("4", "afternoon peak"): 2.0}
    assert snapshot.snap_kpi(snap).first().delayed_ratio == 1.0


def test_snapshot_empty_gives_no_statistics(spark):
    snap = snapshot.snapshot_input(_obs(spark, []), _stops(spark))
    assert snapshot.snap_kpi(snap).count() == 0
    assert snapshot.snap_hourly_trend(snap).count() == 0


def test_time_period_pivot_orders_known_then_other_periods(spark):
    matrix = spark.createDataFrame(
        [("4", "other period", 1.0, 2), ("4", "night", 3.0, 1), ("6", "morning peak", 2.0, 5), ("4", "dawn", 0.5, 1),
         ("6", None, 4.0, 2)],
        "route_number string, time_period string, avg_delay_minutes double, observation_count bigint")
    out = reporting.time_period_pivot(matrix)
    assert out.columns == [
        "route_number",
        "morning_peak_avg_delay_minutes", "morning_peak_observation_count",
        "afternoon_peak_avg_delay_minutes", "afternoon_peak_observation_count",
        "other_period_avg_delay_minutes", "other_period_observation_count",
        "dawn_avg_delay_minutes", "dawn_observation_count",
        "night_avg_delay_minutes", "night_observation_count",
        "unknown_avg_delay_minutes", "unknown_observation_count",
    ]
    rows = {r.route_number: r for r in out.collect()}
    assert rows["4"].morning_peak_avg_delay_minutes is None and rows["4"].night_observation_count == 1
    assert rows["6"].morning_peak_observation_count == 5 and rows["6"].unknown_observation_count == 2


def test_empty_scope_gives_zero_kpi_and_dense_hours(spark):
    from delaystar.operators import warehouse
    from delaystar.plans.registry import Job

    from .conftest import SMALL_SF

    j = Job(spark, SMALL_SF)
    view = warehouse.dashboard_view(j.wh, route_numbers=("99",))
    assert view.count() == 0
    assert tuple(reporting.kpi_summary(view).first()) == (0.0, 0.0, 0, 0.0, 0)
    hours = reporting.hourly_delay_trend(view).collect()
    assert len(hours) == 24 and all(h.observation_count == 0 for h in hours)
    assert reporting.stop_delay_ranking(view).count() == 0
    assert reporting.hourly_merge(reporting.hourly_partials(view)).count() == 0  # empty in, empty out




def test_page_statistics_equal_the_single_ones_with_one_scan(spark, monkeypatch):
    from delaystar.operators import onepass
    from delaystar.session import dimension, scratch_path

    j = Job(spark, SMALL_SF)
    path = scratch_path(spark, "view")
    j.view.write.parquet(path)
    view = spark.read.parquet(path)
    grouped = []
    monkeypatch.setattr(onepass, "dimension", lambda df: (grouped.append(df), dimension(df))[1])
    parts = reporting.load_statistics(view)
    single = {name: getattr(reporting, name)(view) for name in parts}
    assert {n: list(map(tuple, df.collect())) for n, df in parts.items()} == {n: list(map(tuple, df.collect())) for n, df in single.items()}
    assert len(parts) == 6 and len(grouped) == 1
    assert grouped[0]._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    for df in parts.values():  # what is left reads the written groups only
        assert path not in "".join(df.inputFiles())


def test_snapshot_statistics_equal_the_single_ones_with_one_scan(spark, monkeypatch):
    from delaystar.operators import onepass
    from delaystar.session import dimension

    j = Job(spark, SMALL_SF)
    snap = dimension(snapshot.snapshot_input(j.raw, j.stops, j.zone))
    grouped = []
    monkeypatch.setattr(onepass, "dimension", lambda df: (grouped.append(df), dimension(df))[1])
    parts = snapshot.statistics_of(snap)
    names = {"kpi_summary": "snap_kpi", "stop_delay_ranking": "snap_stop_ranking", "daily_delay_trend": "snap_daily_trend",
             "hourly_delay_trend": "snap_hourly_trend", "delay_category_breakdown": "snap_category_breakdown",
             "time_period_delay_matrix": "snap_time_period_matrix"}
    single = {n: getattr(snapshot, names.get(n, n))(snap) for n in parts}
    assert {n: list(map(tuple, df.collect())) for n, df in parts.items()} == {n: list(map(tuple, df.collect())) for n, df in single.items()}
    assert len(parts) == 9 and len(grouped) == 1
    assert grouped[0]._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_one_pass_statistics_of_nothing(spark):
    j = Job(spark, SMALL_SF)
    parts = reporting.load_statistics(j.view.limit(0))
    single = {name: getattr(reporting, name)(j.view.limit(0)) for name in parts}
    assert {n: list(map(tuple, df.collect())) for n, df in parts.items()} == {n: list(map(tuple, df.collect())) for n, df in single.items()}
    empty = snapshot.statistics_of(snapshot.snapshot_input(j.raw.limit(0), j.stops, j.zone))
    assert all(df.count() == 0 for df in empty.values())


def test_hourly_merge_of_a_row_without_an_hour(spark):
    rows = spark.createDataFrame([(None, 1.0, 4)], "observed_hour int, avg_delay_minutes double, observation_count bigint")
    assert [r.observation_count for r in reporting.hourly_merge(rows).collect()] == [4] + [0] * 23  # clamped like a negative one
    assert reporting.hourly_merge(rows.limit(0)).count() == 0


def test_a_statistic_through_sql_on_the_named_view(spark):
    from delaystar.operators import warehouse

    j = Job(spark, SMALL_SF)
    name = warehouse.register_dashboard_view(j.wh)
    assert name == "v_delay_dashboard"
    n = spark.sql(f"SELECT sum(observation_count) AS n FROM {name}").first().n
    assert n == reporting.kpi_summary(j.view).first().observation_count


def test_pivot_columns_of_periods_that_differ_in_punctuation(spark):
    rows = [("4", "night bus", 1.0, 2), ("4", "night-bus", 2.0, 3), ("4", "night_bus", 3.0, 4)]
    matrix = spark.createDataFrame(rows, "route_number string, time_period string, avg_delay_minutes double, observation_count bigint")
    out = reporting.time_period_pivot(matrix)
    assert len(set(out.columns)) == len(out.columns)
    row = out.first().asDict()
    assert sorted(v for k, v in row.items() if k.startswith("night_bus") and k.endswith("_count")) == [2, 3, 4]
