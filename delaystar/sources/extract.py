"""Extraction from the operational store (S2..S5).

The reader is a callable ``(spark, table) -> DataFrame`` so the same projection
runs on a JDBC source (production) and on parquet stand-ins (tests).  For JDBC,
``jdbc_reader`` splits the read on ``created_at`` so the extract is parallel
instead of one input split.  Even ranges are uneven splits where observations come in
bursts, so ``planned_jdbc_reader`` plans its splits from the source's own histogram: an
aggregate that the source computes, one row per hour.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaystar.sources import sinks

Reader = Callable[[SparkSession, str], DataFrame]


def jdbc_reader(url: str, properties: dict[str, str], partition_column: str = "created_at",
                lower_bound: str | None = None, upper_bound: str | None = None, num_partitions: int = 64) -> Reader:
    """JDBC reader; observations are read in ``num_partitions`` range splits, so their bounds are required."""
    def read(spark: SparkSession, table: str) -> DataFrame:
        r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
        for k, v in properties.items():
            r = r.option(k, v)
        if table.endswith("delay_observations"):
            if not (lower_bound and upper_bound):
                raise ValueError("reading observations needs both bounds of the partition column")
            r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
                 .option("upperBound", upper_bound).option("numPartitions", num_partitions))
        return r.load()
    return read


#: How a dialect deals the rows of one hour into parts by a key column (parts, number of the part).
SPARK_PART = "pmod(hash({key}), {parts}) = {part}"
POSTGRES_PART = "mod(hashtext({key})::bigint + 2147483648, {parts}) = {part}"


def histogram_sql(table: str, column: str = "created_at") -> str:
    """Rows per hour of ``column`` (no hour: missing times); both Spark and PostgreSQL run it."""
    return f"SELECT date_trunc('HOUR', {column}) AS hour, count(*) AS n FROM {table} GROUP BY 1"


def plan_splits(histogram: Iterable[tuple[dt.datetime | None, int]], splits: int, column: str = "created_at", key: str = "id",
                part: str = SPARK_PART) -> list[str]:
    """Predicates of disjoint splits that cover every row, each near the mean of ``splits`` parts.

    Consecutive hours share a split up to the mean; an hour above it is dealt into
    parts by a hash of ``key``, as are the rows without a time, which have splits of their
    own.  No split holds more than twice the mean, but for what a single key holds.
    """
    rows = [(h, n) for h, n in histogram if n]
    mean = max(1, -(-sum(n for _, n in rows) // max(1, splits)))

    def parts(condition: str, n: int) -> list[str]:
        many = -(-n // mean)
        return [f"{condition} AND {part.format(key=key, parts=many, part=k)}" for k in range(many)] if many > 1 else [condition]

    out = [p for h, n in rows if h is None for p in parts(f"{column} IS NULL", n)]
    held: list[dt.datetime] = []
    size = 0

    def span(first: dt.datetime, last: dt.datetime) -> str:
        end = last + dt.timedelta(hours=1)
        return f"{column} >= TIMESTAMP '{first:%Y-%m-%d %H:%M:%S}' AND {column} < TIMESTAMP '{end:%Y-%m-%d %H:%M:%S}'"

    for hour, n in sorted((h, n) for h, n in rows if h is not None):
        if held and size + n > mean:
            out.append(span(held[0], held[-1]))
            held, size = [], 0
        if n > mean:
            out += parts(span(hour, hour), n)
        else:
            held.append(hour)
            size += n
    return out + ([span(held[0], held[-1])] if held else [])


def planned_jdbc_reader(url: str, properties: dict[str, str], splits: int = 64, column: str = "created_at") -> Reader:
    """JDBC reader of observations with one task per planned split; other tables are read as they are."""
    def read(spark: SparkSession, table: str) -> DataFrame:
        if not table.endswith("delay_observations"):
            return jdbc_reader(url, properties)(spark, table)
        histogram = spark.read.jdbc(url, f"({histogram_sql(table, column)}) AS h", properties=properties)
        planned = plan_splits([tuple(r) for r in histogram.collect()], splits, column, part=POSTGRES_PART)
        return spark.read.jdbc(url, table, predicates=planned or ["1 = 1"], properties=properties)
    return read


def parquet_reader(root: str) -> Reader:
    return lambda spark, table: spark.read.parquet(f"{root.rstrip('/')}/{table}")


def operational_observations(observations: DataFrame) -> DataFrame:
    """Observation table as the operational store keeps it (``id``, 32-bit ints)."""
    return observations.select(
        F.col("observation_id").alias("id"), "collection_run_id", "route_id", "stop_id", "trip_id", "headsign",
        "direction_id", F.col("stop_sequence").cast("int").alias("stop_sequence"), "scheduled_departure",
        "predicted_departure", F.col("delay_seconds").cast("int").alias("delay_seconds"), "delay_category",
        "created_at", "duplicate_key",
    )


# Rename the key and widen the integers; created_at unchanged
def extract_observations(source: DataFrame) -> DataFrame:
    return source.select(
        F.col("id").alias("observation_id"), "collection_run_id", "route_id", "stop_id", "trip_id", "headsign",
        "direction_id", F.col("stop_sequence").cast("bigint").alias("stop_sequence"), "created_at",
        "scheduled_departure", "predicted_departure", F.col("delay_seconds").cast("bigint").alias("delay_seconds"),
        "delay_category", "duplicate_key",
    )


# Copies of the store's tables into raw, replaced as a whole
def extract_table(spark: SparkSession, reader: Reader, table: str, raw_root: str) -> DataFrame:
    sinks.replace_table(reader(spark, table), f"{raw_root.rstrip('/')}/{table}")
    return sinks.read_current(spark, f"{raw_root.rstrip('/')}/{table}")


# The collector's monitored stops as a small literal dimension
def monitored_stops(spark: SparkSession) -> DataFrame:
    from delaystar import settings

    rows = [(sid, name, list(routes), direction) for sid, name, routes, direction in settings.MONITORED_STOPS]
    return spark.createDataFrame(
        rows, "stop_id string, stop_name string, route_short_names array<string>, direction_label string")
