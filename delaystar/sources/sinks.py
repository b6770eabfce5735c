"""Sinks: versioned replace, date-partitioned fact, schema bootstrap, control log.

All writes go below a folder the caller names (on a cluster: shared storage,
e.g. under ``spark.checkpoint.dir``); nothing is written to a machine-local
temporary folder.  A replaced table is written to a fresh version directory and
only then becomes current through a one-line pointer, so a reader never sees a
half-written table and a job may read the table it replaces (T12).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaystar import schemas
from delaystar.functions import columns as C
from delaystar.operators.warehouse import occurring

POINTER = "_CURRENT"
LOCATED = "_located"


class PartialBatchError(ValueError):
    """A replace sink refuses incremental (partial) input."""


# S6 / I2
def replace_table(df: DataFrame, root: str, *, incremental: bool = False, partition_by: tuple[str, ...] = ()) -> str:
    """Write ``df`` as a new version under ``root`` and make it current; returns the version path."""
    if incremental:
        raise PartialBatchError("a truncate/replace sink must never receive a partial incremental batch")
    version = f"{root.rstrip('/')}/v-{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(version)
    spark = df.sparkSession
    lines = _pointer_lines(spark, root)
    last = max((int(line.split(" ", 1)[0]) for line in lines), default=0)
    # a new numbered line is added, none is deleted: a reader always finds a pointer
    pointer = spark.createDataFrame([(f"{last + 1:020d} {version}",)], "line string")
    pointer.coalesce(1).write.mode("append").text(f"{root}/{POINTER}")
    return version


def _pointer_lines(spark: SparkSession, root: str) -> list[str]:
    """Numbered versions of a table (one line per replacement); none for a new table."""
    try:
        return [r[0] for r in spark.read.text(f"{root}/{POINTER}").collect()]
    except AnalysisException as e:
        if not path_missing(e):
            raise
        return []


def path_missing(error: AnalysisException) -> bool:
    """True only for a path that does not exist (yet); other read problems are errors."""
    return error.getCondition() == "PATH_NOT_FOUND"


def current_version(spark: SparkSession, root: str) -> str:
    lines = _pointer_lines(spark, root)
    if not lines:
        raise FileNotFoundError(f"no version of {root}")
    return max(lines).split(" ", 1)[1]


def read_current(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(current_version(spark, root))


# Fact partitioned by UTC date, clustered by route and stop inside files
def write_fact_partitioned(fact: DataFrame, path: str, partitions: int | None = None, mode: str = "overwrite",
                           located_by: str | None = None) -> None:
    """Range-partition on (date, route, stop, id) so every task writes few date folders
    with rows clustered by route/stop (parquet min/max skipping), and one hot
    date is split across tasks instead of landing in one.  Without an explicit
    ``partitions`` AQE sizes the write tasks from the shuffle statistics, so the
    file count follows the data volume.

    ``located_by`` names a time that an id fixes; the pairs (its day, observed date) of
    the rows are added to the fact's index (``LOCATED``, a hidden folder), before the fact is
    written, so that the index never lacks a date that holds a row."""
    out = fact.withColumn("observed_date", F.to_date("observed_at")) if "observed_date" not in fact.columns else fact
    # the unique id as last key lets the range partitioner split even one hot
    # (date, route, stop) value across tasks, without losing the clustering
    keys = ("observed_date", "route_key", "stop_key", "source_observation_id")
    ranged = out.repartitionByRange(partitions, *keys) if partitions else out.repartitionByRange(*keys)
    if located_by:
        pairs = out.select(F.to_date(located_by).alias("located_day"), "observed_date").distinct()
        pairs.write.mode("append").parquet(f"{path.rstrip('/')}/{LOCATED}")
    (
        ranged.sortWithinPartitions(*keys)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("observed_date")
        .parquet(path)
    )


def morton(fact: DataFrame, dim_route: DataFrame, dim_stop: DataFrame, name: str = "_place", stored: bool = False) -> DataFrame:
    """Add the interleaved bits of the route's and the stop's place among the keys of their dimensions.

    In the order of that number both keys stay together: rows of one stop are in few stretches,
    as are rows of one route.  Places are ranks in the (small) dimensions, scaled to 16 bits;
    keys that a dimension lacks come last.  ``stored``: the fact is cheap to read again.
    """
    def places(dim: DataFrame, key: str, as_name: str) -> DataFrame:
        keys = dim.select(key).distinct()
        return keys.select(key, F.floor(F.percent_rank().over(Window.orderBy(key)) * 65535).cast("int").alias(as_name))

    def spread(c: str) -> F.Column:
        """A 16-bit number with a zero after each bit."""
        x = F.coalesce(F.col(c), F.lit(65535))
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
        return x.cast("bigint")

    routes, stops = places(dim_route, "route_key", "_r"), places(dim_stop, "stop_key", "_s")
    if stored:  # ranked among all keys, then cut to the fact's
        routes, stops = occurring(routes, "route_key", fact), occurring(stops, "stop_key", fact)
    placed = fact.join(routes, "route_key", "left").join(stops, "stop_key", "left")
    return placed.withColumn(name, spread("_r") * 2 + spread("_s")).select(*fact.columns, name)


def write_fact_interleaved(fact: DataFrame, path: str, dim_route: DataFrame, dim_stop: DataFrame, partitions: int | None = None,
                           stored: bool = False) -> None:
    """S10 for filters on stop as well as on route: inside a date, files are ranges of the interleaved order.

    File statistics of both keys are then narrow, so a filter on either skips most files of
    a date; with the (route, stop) order a filter on a stop alone skips few.
    """
    out = fact.withColumn("observed_date", F.to_date("observed_at")) if "observed_date" not in fact.columns else fact
    keys = ("observed_date", "_place", "source_observation_id")
    placed = morton(out, dim_route, dim_stop, stored=stored)
    ranged = placed.repartitionByRange(partitions, *keys) if partitions else placed.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).drop("_place").write.mode("errorifexists").partitionBy("observed_date").parquet(path)


def dates_located(spark: SparkSession, path: str, batch: DataFrame, located_by: str) -> DataFrame:
    """observed_date of the partitions that can hold a row whose ``located_by`` is on one of the batch's days.

    The index has a row per pair of days and write, and may list dates whose rows have moved.
    """
    index = spark.read.schema("located_day date, observed_date date").parquet(f"{path.rstrip('/')}/{LOCATED}")
    days = batch.select(F.to_date(located_by).alias("_day")).distinct()
    return index.join(days, F.col("located_day").eqNullSafe(F.col("_day")), "left_semi").select("observed_date").distinct()


def drop_partitions(spark: SparkSession, path: str, column: str, values: list) -> None:
    """Remove the folders of the given partition values (dates that a merge has emptied)."""
    jvm = spark.sparkContext._jvm
    for value in values:
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
        folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{column}={name}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """Table-based source of the written fact."""
    return spark.read.parquet(path)


def fact_for_local_dates(fact: DataFrame, date_from: str, date_to: str, zone: str) -> DataFrame:
    """Local calendar-date range on a UTC-date-partitioned fact.

    A local date never spans more than the UTC day before or after it, so a
    one-day-widened filter on ``observed_date`` prunes partitions; the exact
    local-date filter then keeps the right rows.
    """
    lo = F.date_sub(F.lit(date_from).cast("date"), 1)
    hi = F.date_add(F.lit(date_to).cast("date"), 1)
    local_date = F.to_date(C.local_time("observed_at", zone))
    return fact.filter(F.col("observed_date").between(lo, hi)).filter(
        local_date.between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date")))


# Create the operational and warehouse tables when absent; existing ones are kept
def create_schemas(spark: SparkSession, root: str) -> DataFrame:
    rows = []
    for name, schema in schemas.ALL_TABLES.items():
        path = f"{root.rstrip('/')}/{name}"
        try:
            existing = spark.read.parquet(path)
            created = False
        except AnalysisException as e:
            if not path_missing(e):
                raise
            spark.createDataFrame([], schema).write.mode("errorifexists").parquet(path)
            existing = spark.read.parquet(path)
            created = True
        rows.append((name, path, len(existing.columns), created))
    return spark.createDataFrame(rows, "table_name string, path string, column_count int, created boolean")


CONTROL_SCHEMA = T.StructType([
    T.StructField("cycle_id", T.StringType()),
    T.StructField("refreshed_at", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("fact_rows", T.LongType()),
    T.StructField("issue_count", T.LongType()),
])


def cycle_outcome(checks: DataFrame, cycle_id: str | None = None) -> DataFrame:
    """The control row of a cycle; ``checks`` is the one row of the warehouse checks.

    Every counter of Q2..Q9 counts as issues, and so do the rows by which usable raw
    rows and fact rows differ (Q1): a cycle that lost rows is not a success.
    """
    counted = [c for c in checks.columns if c not in ("usable_raw_rows", "fact_rows")]
    lost = F.abs(F.col("usable_raw_rows") - F.col("fact_rows"))
    total = sum((F.col(c) for c in counted), lost)
    return checks.select(total.cast("bigint").alias("issue_count"), "fact_rows").select(
        F.lit(cycle_id or uuid.uuid4().hex).alias("cycle_id"),
        F.expr("convert_timezone(current_timezone(), 'UTC', localtimestamp())").alias("refreshed_at"),
        F.when(F.col("issue_count") == 0, "success").otherwise("failed").alias("status"),
        "fact_rows",
        "issue_count",
    )


# Append the cycle's outcome; a cycle with issues is logged as failed, never success
def log_cycle(checks: DataFrame, control_path: str, cycle_id: str | None = None) -> DataFrame:
    cycle_outcome(checks, cycle_id).write.mode("append").parquet(control_path)
    return checks.sparkSession.read.schema(CONTROL_SCHEMA).parquet(control_path)
