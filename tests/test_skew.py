"""One key holding a third of all rows: results stay whole and the plans reduce
the hot key before the shuffle (partial WindowGroupLimit)."""

import datetime as dt

from pyspark.sql import functions as F

from delaystar.operators import dedup, incremental


def _hot(spark, n=3000):
    t = dt.datetime(2024, 5, 1, 12, 0)
    base = spark.range(n).select(
        F.concat(F.lit("o"), F.col("id").cast("string")).alias("observation_id"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("K"), F.col("id").cast("string")))
        .alias("duplicate_key"),
        F.timestamp_add("SECOND", F.col("id"), F.lit(t).cast("timestamp_ntz")).alias("created_at"),
        F.col("id").alias("tie_1"), F.lit(0).cast("bigint").alias("tie_2"),
        F.lit(0.0).alias("tie_3"), F.lit(0.0).alias("tie_4"),
        (F.col("id") % 400).alias("delay_seconds"),
        F.lit("R").alias("collection_run_id"), F.lit("r").alias("route_id"), F.lit("s").alias("stop_id"),
    )
    return base.repartition(8)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_wins_with_a_hot_key(spark):
    df = _hot(spark)
    out = dedup.dedup_first_by_key(df)
    assert out.count() == 1 + 2000  # the hot key once, every other key once
    assert out.filter("duplicate_key = 'HOT'").first().observation_id == "o0"
    plan = _plan(out)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_merge_of_a_small_batch_does_not_shuffle_the_target(spark):
    from delaystar.session import dimension

    target = dimension(_hot(spark))
    batch = dimension(_hot(spark, 30).withColumn("delay_seconds", F.lit(7).cast("bigint")))
    merged = incremental.merge_raw(target, batch)
    assert merged.count() == 3000 and merged.filter("delay_seconds = 7").count() >= 30
    plan = _plan(merged)
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "Exchange hashpartitioning" not in plan


def test_upsert_reduces_before_the_exchange(spark):
    from delaystar.operators import ingest

    df = _hot(spark).select(F.col("duplicate_key").alias("id"), F.col("created_at").alias("fetched_at"),
                            F.col("observation_id").alias("payload_id"), F.lit(0).alias("position"))
    ups = ingest.upsert_entities(df.select("id").limit(0), df)
    assert ups.count() == 2001
    assert "Partial" in _plan(ups)


def test_insert_ignore_counts_with_a_hot_key(spark):
    df = _hot(spark)
    accepted = dedup.insert_ignore(df.limit(0), df)
    s = dedup.save_summary(df, accepted).first()
    assert (s.delay_observations_saved, s.duplicate_observations_skipped) == (2001, 999)


def test_dimensions_are_broadcast_by_the_planners_byte_threshold(spark):
    from delaystar.session import dimension

    small = dimension(spark.range(5).withColumnRenamed("id", "k"))
    big = dimension(spark.range(200_000).selectExpr("id AS k", "uuid() AS v"))
    assert "BroadcastHashJoin" in _plan(big.join(small, "k"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert "SortMergeJoin" in _plan(big.join(small, "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_fact_write_splits_one_hot_date_route_stop(spark):
    import glob

    from delaystar.session import scratch_path
    from delaystar.sources import sinks

    t = dt.datetime(2024, 5, 1, 12, 0)
    fact = spark.range(4000).select(
        F.concat(F.lit("o"), F.col("id").cast("string")).alias("source_observation_id"),
        F.lit("R").alias("route_key"), F.lit("S").alias("stop_key"),
        F.lit(t).cast("timestamp_ntz").alias("observed_at"),
    )
    path = scratch_path(spark, "hot-fact")
    sinks.write_fact_partitioned(fact, path, partitions=4)
    assert len(glob.glob(f"{path}/observed_date=*/*.parquet")) == 4  # one value, four writer tasks
    assert spark.read.parquet(path).count() == 4000


def test_insert_ignore_prunes_store_partitions_to_the_batch_range(spark):
    from delaystar.plans.registry import Job
    from delaystar.session import scratch_path

    from .conftest import SMALL_SF

    j = Job(spark, SMALL_SF)
    store = scratch_path(spark, "store")
    j.observations.withColumn("scheduled_date", F.to_date("scheduled_departure")) \
        .write.partitionBy("scheduled_date").parquet(store)
    target = spark.read.parquet(store)
    batch = j.raw.filter(F.col("scheduled_departure") < F.lit("2024-01-05").cast("timestamp_ntz"))
    out = dedup.insert_ignore(target, batch)
    assert out.count() == 0  # everything in the batch is already stored
    plan = _plan(out)
    assert "scheduled_date" in plan and "Subquery" in plan
