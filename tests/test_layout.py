"""Split planning of the extract (S4) and the two-key layout of the fact."""

import datetime as dt
import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from delaystar.session import dimension, scratch_path
from delaystar.sources import extract, sinks

from .test_snapshots import FACT_SCHEMA, fact_row


def _observations(spark):
    """Skewed: half of all rows in one hour, a tenth without a time, the rest over 200 days."""
    i = F.col("i")
    days = F.expr("timestampadd(MINUTE, CAST(i * 271 % 288000 AS INT), TIMESTAMP_NTZ '2024-01-01 00:00:00')")
    created = F.when(i % 2 == 0, F.expr("timestampadd(SECOND, CAST(i % 3600 AS INT), TIMESTAMP_NTZ '2024-03-05 08:00:00')")).when(i % 10 != 1, days)
    return dimension(spark.range(20_000).select(F.col("id").alias("i")).select(F.concat(F.lit("O"), "i").alias("id"), created.alias("created_at")))


@pytest.mark.parametrize("splits", [1, 7, 64])
def test_planned_splits_cover_each_row_once_and_are_even(spark, splits):
    rows = _observations(spark)
    rows.createOrReplaceTempView("split_source")
    histogram = [tuple(r) for r in spark.sql(extract.histogram_sql("split_source")).collect()]
    planned = extract.plan_splits(histogram, splits)
    sizes = rows.agg(*[F.count_if(F.expr(p)).alias(f"c{k}") for k, p in enumerate(planned)]).first()
    assert sum(sizes) == rows.count() == 20_000
    held = F.array_size(F.filter(F.array(*[F.expr(p) for p in planned]), lambda x: F.coalesce(x, F.lit(False))))
    assert rows.where(held != 1).isEmpty()
    assert max(sizes) <= 2 * 20_000 / splits
    assert len(planned) <= 3 * splits + 2


def test_splits_of_little_or_nothing():
    assert extract.plan_splits([], 8) == []
    assert extract.plan_splits([(None, 0)], 8) == []
    hour = dt.datetime(2024, 1, 1, 5)
    assert extract.plan_splits([(hour, 1), (None, 1)], 1) == [
        "created_at IS NULL", "created_at >= TIMESTAMP '2024-01-01 05:00:00' AND created_at < TIMESTAMP '2024-01-01 06:00:00'"]
    assert all("hashtext(id)" in p for p in extract.plan_splits([(hour, 10)], 5, part=extract.POSTGRES_PART))


def _files_met(path, column, value):
    """Files whose statistics do not rule the value out, and all files."""
    met = files = 0
    for f in glob.glob(f"{path}/observed_date=*/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        stats = [next(g.column(c).statistics for c in range(g.num_columns) if g.column(c).path_in_schema == column)
                 for g in map(meta.row_group, range(meta.num_row_groups))]
        files += 1
        met += any(s.min <= value <= s.max for s in stats)
    return met, files


def test_interleaved_layout_skips_files_for_a_stop_and_for_a_route(spark):
    n = 32
    rows = []
    for i in range(n * n * 4):
        r = list(fact_row(i, 0))
        r[2], r[3] = f"R{i % n:02d}", f"S{i // n % n:02d}"
        rows.append(tuple(r))
    fact = dimension(spark.createDataFrame(rows, FACT_SCHEMA))
    routes = spark.createDataFrame([(f"R{k:02d}",) for k in range(n)], "route_key string")
    stops = spark.createDataFrame([(f"S{k:02d}",) for k in range(n)], "stop_key string")
    plain, both = scratch_path(spark, "plain"), scratch_path(spark, "both")
    sinks.write_fact_partitioned(fact, plain, partitions=16)
    sinks.write_fact_interleaved(fact, both, routes, stops, partitions=16)
    assert sorted(map(tuple, sinks.read_fact(spark, both).select(*fact.columns).collect())) == sorted(map(tuple, fact.collect()))
    stop_plain, files = _files_met(plain, "stop_key", "S09")
    stop_both, files_both = _files_met(both, "stop_key", "S09")
    route_both, _ = _files_met(both, "route_key", "R09")
    assert files >= 12 and files_both >= 12
    assert stop_plain > 0.9 * files  # route sorts first: every file has every stop
    assert stop_both <= files_both / 2 and route_both <= files_both / 2


def test_keys_that_a_dimension_lacks_are_kept(spark):
    fact = spark.createDataFrame([fact_row(1, 0), (*fact_row(2, 0)[:2], None, None, *fact_row(2, 0)[4:])], FACT_SCHEMA)
    empty = spark.createDataFrame([], "route_key string, stop_key string")
    assert sinks.morton(fact, empty.select("route_key"), empty.select("stop_key")).count() == 2
