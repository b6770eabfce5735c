"""A cycle and its rerun: rows shuffled and written follow the batch, results do not change."""

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from delaystar.operators import dedup, incremental, warehouse
from delaystar.plans import registry
from delaystar.plans.registry import Job
from delaystar.session import dimension

from .conftest import SMALL_SF

ROW = "observation_id string, scheduled_departure timestamp_ntz, v bigint"


def rows(df):
    return sorted(map(repr, df.collect()))


def written_rows(spark, root_before):
    return sum(pq.ParquetFile(f).metadata.num_rows for d in dimensions(spark) - root_before for f in glob.glob(f"{d}/t/*.parquet"))


def dimensions(spark):
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://").removeprefix("file:")
    return set(glob.glob(os.path.join(folder, "dimension-*")))


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_merge_by_days_equals_the_merge_by_id(spark):
    day = [dt.datetime(2024, 1, d, 12) for d in range(1, 5)]
    target = spark.createDataFrame([("a", day[0], 1), ("a", day[1], 2), ("b", day[1], 3), ("c", day[2], 4), ("c", day[2], 4),
                                    (None, day[0], 5), ("d", None, 6), ("e", None, 7), ("f", day[3], 8)], ROW)
    for batch in ([("a", day[3], 10), (None, day[2], 11), ("new", None, 12)], [("d", day[0], 13)], [("x", day[1], 14)], []):
        batch = spark.createDataFrame(batch, ROW)
        kept, merged = dedup.merge_days(target, batch, "observation_id", "scheduled_departure")
        assert kept.columns == merged.columns == target.columns
        assert rows(kept.unionByName(merged)) == rows(dedup.merge_by_id(target, batch, "observation_id"))


def test_a_cycle_writes_again_only_the_days_of_its_batch(spark, no_broadcast):
    j = Job(spark, SMALL_SF)
    target = dimension(registry._merge_target(j))
    wh = warehouse.build_warehouse(target, j.routes, j.stops, j.zone, stored=True)
    cycle = incremental.incremental_cycle(wh, target, registry._merge_batch(j), j.routes, j.stops)
    before = dimensions(spark)
    raw, fact = cycle.store()
    batch = incremental.batch_dedup(registry._merge_batch(j))
    days = batch.select(F.to_date("scheduled_departure").alias("d")).distinct()
    touched = target.join(days, F.to_date("scheduled_departure") == F.col("d"), "left_semi").count() + batch.count()
    assert 0 < written_rows(spark, before) <= 2 * touched + 40 < target.count()
    assert rows(raw) == rows(incremental.merge_raw(target, batch))
    assert rows(fact) == rows(incremental.merge_fact(wh.fact, cycle.batch_fact))


def test_rerun_differences_names_changed_missing_and_repeated_keys(spark):
    first = spark.range(5000).select(F.concat(F.lit("O"), "id").alias("k"), F.col("id").alias("v"))
    same = incremental.rerun_differences(first, first.repartition(3), "k").first()
    assert tuple(same) == (0, 5000, 0)
    second = first.where("v <> 7").withColumn("v", F.when(F.col("v") == 9, 0).otherwise(F.col("v"))).unionByName(
        first.where("v IN (11, 12)")).unionByName(spark.createDataFrame([("new", 1)], "k string, v bigint"))
    # O7 missing 1, O9 changed 2, O11 and O12 repeated 3 each, one new
    assert tuple(incremental.rerun_differences(first, second, "k").first()) == (10, 5002, 2)
    nothing = first.where("v < 0")
    assert tuple(incremental.rerun_differences(nothing, nothing, "k").first()) == (0, 0, 0)
    keyless = spark.createDataFrame([(None, 1), (None, 2)], "k string, v bigint")
    assert tuple(incremental.rerun_differences(keyless, keyless, "k").first()) == (4, 2, 1)


def test_equal_runs_are_compared_without_shuffling_their_rows(spark):
    n = 50_000
    run = dimension(spark.range(n).select(F.concat(F.lit("O"), "id").alias("k"), *[F.col("id").alias(f"v{i}") for i in range(4)]))
    text = incremental.rerun_differences(run, run, "k")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text
