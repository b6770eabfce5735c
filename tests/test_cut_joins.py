"""Large reference tables, histories and parses: what a query shuffles, writes or holds follows the rows it needs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from delaystar.operators import dedup, ingest, warehouse
from delaystar.plans import registry
from delaystar.plans.registry import Job
from delaystar.session import dimension
from delaystar.sources import payloads
from delaystar.streaming import collector

from .conftest import SMALL_SF


@pytest.fixture
def many_stops(spark):
    """The stops among 50,000 that no observation names, above the broadcast threshold."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "40000")
    j = Job(spark, SMALL_SF)
    more = spark.range(50_000).select(F.concat(F.lit("S_X"), "id").alias("id"), F.lit("name").alias("name"), F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"))
    yield j, dimension(j.stops.unionByName(more))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, df.collect()))


def test_payloads_are_not_shuffled_on_hot_stops(many_stops):
    j, stops = many_stops
    for build in (payloads.departure_payloads, payloads.search_payloads):
        big = build(j.raw, j.routes, stops)
        assert "SortMergeJoin" not in plan(big)
        assert rows(big) == rows(build(j.raw, j.routes, j.stops))


def test_the_fact_of_a_written_history_is_not_shuffled_on_hot_stops(many_stops):
    j, stops = many_stops
    target = dimension(j.observations)
    wh = warehouse.build_warehouse(target, j.routes, stops, j.zone, stored=True)
    assert "SortMergeJoin" not in plan(wh.fact)
    assert rows(wh.fact) == rows(warehouse.build_warehouse(target, j.routes, j.stops, j.zone).fact)


def test_later_rows_leave_a_history_before_the_shuffle(spark):
    j = Job(spark, SMALL_SF)
    for history, until in ((registry._history, registry.HISTORY_UNTIL), (registry._merge_target, registry.TARGET_UNTIL)):
        got = history(j)
        text = got._jdf.queryExecution().optimizedPlan().toString()
        assert until.isoformat(" ")[:10] in text[text.index("Window"):]
        assert rows(got) == rows(j.observations.where(F.col("created_at") < F.lit(until).cast("timestamp_ntz")))


def test_one_written_parse_serves_refused_and_accepted_payloads(spark):
    j = Job(spark, SMALL_SF)
    scanned = ingest.scan_payloads(dimension(payloads.departure_payloads(j.raw, j.routes, j.stops)))
    both = dimension(ingest.parse_payloads(scanned, 4, "body"))
    refused = both.where(~F.col("accepted"))
    assert rows(refused.select("payload_id", "error_message", "body")) == rows(scanned.where(~F.col("accepted")).select("payload_id", "error_message", "body"))
    assert both.where(F.col("accepted") & F.col("body").isNotNull()).isEmpty() and refused.where(F.size("_kept") > 0).isEmpty()
    parsed, history = both.where("accepted"), registry._history(j)
    want = ingest.collect_accepted(history, ingest.parsed_observations(ingest.parse_departures(scanned, 4)))
    got = ingest.collect_parsed(history, parsed)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_a_batch_is_inserted_without_being_held(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(DataFrame, "persist", lambda *a, **k: pytest.fail("the batch is held"))
    j = Job(spark, SMALL_SF)
    batch = dimension(j.raw)
    for _ in range(2):  # the second finds every key known
        collector.insert_ignore_batch(batch, str(tmp_path / "store"))
    stored = spark.read.parquet(str(tmp_path / "store"))
    assert stored.count() == dedup.dedup_first_by_key(batch).count()
    assert stored.agg(F.min("scheduled_date")).first()[0] >= dt.date(2024, 1, 1)
