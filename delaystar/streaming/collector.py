"""Structured Streaming collector (I8) and overlap dedup with bounded state.

I8 replaces the scheduled collector loop: landed observation files are a file
stream; every micro-batch is inserted into the store with first-wins semantics
on ``duplicate_key`` (in-batch ``row_number`` + anti join against the store).
The anti join reads only the store partitions of the batch's scheduled dates
(the store is partitioned by ``scheduled_date`` and the key embeds the
scheduled instant), so a batch never scans the whole history.  Replaying a
batch after a failure inserts nothing twice: keys already written are skipped.

I9 is the streaming form of "a 2-day overlap tolerates late records":
``dropDuplicatesWithinWatermark`` keeps state only for keys seen within the
watermark, so memory stays bounded; a duplicate older than the watermark can
be admitted again, which is why I8 (exact, all history) is the store's path.

Spark drops rows behind the watermark without a trace.  ``stream_overlap`` keeps
the watermark itself, per micro-batch, and so loses none: every row is counted as
accepted, duplicate or late, late rows are a table of their own, and with a store both
go on to the exact insert of I8.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaystar import settings as S
from delaystar.functions import columns as C
from delaystar.functions import identity
from delaystar.operators import dedup
from delaystar.sources import sinks

SCHEDULED_DATE = "scheduled_date"


def land_observation_files(raw: DataFrame, landing: str) -> None:
    """Write observations as landed files, one folder per creation month, in one job.

    Rows are range-partitioned by creation time, so a large month is several files.
    """
    month = F.coalesce(F.year("created_at") * 100 + F.month("created_at"), F.lit(0))
    (
        raw.withColumn("landed_month", month)
        .repartitionByRange("landed_month", "created_at", "observation_id")
        .write.mode("errorifexists").partitionBy("landed_month").parquet(landing)
    )


def _store_slice(spark: SparkSession, store: str, lo, hi) -> DataFrame | None:
    try:
        existing = spark.read.parquet(store)
    except AnalysisException as e:
        if not sinks.path_missing(e):
            raise
        return None
    return existing.filter(F.col(SCHEDULED_DATE).between(lo, hi)).select("duplicate_key")


def insert_ignore_batch(batch: DataFrame, store: str) -> None:
    """foreachBatch body of I8: first-wins insert of one micro-batch into the store."""
    spark = batch.sparkSession
    first = dedup.dedup_first_by_key(batch).withColumn(SCHEDULED_DATE, F.to_date("scheduled_departure"))
    # the bounds come from one column of the batch's files, so the deduplicated rows are used once
    bounds = batch.select(F.to_date("scheduled_departure").alias("day")).agg(F.min("day").alias("lo"), F.max("day").alias("hi")).first()
    if bounds["lo"] is None:
        return
    known = _store_slice(spark, store, bounds["lo"], bounds["hi"])
    accepted = first if known is None else first.join(known, "duplicate_key", "left_anti")
    accepted.write.mode("append").partitionBy(SCHEDULED_DATE).parquet(store)


def _landed_files(spark: SparkSession, landing_glob: str, schema: T.StructType, files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(landing_glob)


def stream_collect(spark: SparkSession, landing_glob: str, schema: T.StructType, store: str,
                   checkpoint: str, files_per_trigger: int | None = None) -> DataFrame:
    """I8: drain the landed files (availableNow) into the store; returns the store.

    ``files_per_trigger`` bounds a micro-batch; without it the backlog is one batch.
    """
    stream = _landed_files(spark, landing_glob, schema, files_per_trigger)
    q = (
        stream.writeStream.foreachBatch(lambda df, _epoch: insert_ignore_batch(df, store))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.parquet(store).drop(SCHEDULED_DATE)


def event_time(ts_ntz: str) -> F.Column:
    """TIMESTAMP (instant) from a UTC TIMESTAMP_NTZ column, independent of the session
    zone; watermarks require this type."""
    t = F.col(ts_ntz)
    fraction = (identity.micros_of_second(t).cast("decimal(7,0)") / F.lit(1_000_000)).cast("decimal(8,6)")
    secs = F.second(t).cast("decimal(8,6)") + fraction
    return F.make_timestamp(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t),
                            secs.cast("decimal(8,6)"), F.lit("UTC"))


def dedup_within_watermark(stream: DataFrame, keys: list[str], ts_ntz: str, delay: str) -> DataFrame:
    """Streaming dedup on ``keys`` with state bounded by an event-time watermark.

    Rows whose event time is older than the watermark are late and dropped; this
    is why an overlap window needs a backfill after a longer outage.
    """
    return (
        stream.withColumn("_event_time", event_time(ts_ntz))
        .withWatermark("_event_time", delay)
        .dropDuplicatesWithinWatermark(keys)
        .drop("_event_time")
    )


def stream_dedup_overlap(spark: SparkSession, landing_glob: str, schema: T.StructType, out: str,
                         checkpoint: str, overlap_days: int = S.OVERLAP_DAYS, keys: tuple[str, ...] = ("duplicate_key",),
                         ts_ntz: str = "created_at", files_per_trigger: int | None = None) -> DataFrame:
    """Bounded-state dedup within an overlap watermark, file stream -> parquet."""
    stream = _landed_files(spark, landing_glob, schema, files_per_trigger)
    deduped = dedup_within_watermark(stream, list(keys), ts_ntz, f"{overlap_days} days")
    q = (
        deduped.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.schema(schema).parquet(out)


ACCEPTED, LATE, COUNTS = "accepted", "late", "counts"
EVENT_DATE = "event_date"
COUNTS_SCHEMA = "input_rows bigint, accepted bigint, duplicates bigint, late bigint, newest timestamp_ntz, batch_id bigint"


def overlap_counts(spark: SparkSession, root: str) -> DataFrame:
    """One row per micro-batch: its rows by outcome, and the newest time that it had; none for a new stream."""
    try:
        return spark.read.schema(COUNTS_SCHEMA).parquet(f"{root}/{COUNTS}")
    except AnalysisException as e:
        if not sinks.path_missing(e):
            raise
        return spark.createDataFrame([], COUNTS_SCHEMA)


def overlap_rows(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """Accepted or late rows of the complete micro-batches."""
    last = overlap_counts(spark, root).agg(F.max("batch_id")).first()[0]
    if last is None:
        return spark.createDataFrame([], schema)
    kept = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType()), T.StructField(EVENT_DATE, T.DateType())])
    return spark.read.schema(kept).parquet(f"{root}/{table}").where(F.col("batch_id") <= last).select(*schema.names)


def overlap_batch(batch: DataFrame, batch_id: int, root: str, keys: tuple[str, ...], ts_ntz: str, delay: dt.timedelta,
                  store: str | None = None) -> None:
    """foreachBatch body of I9: split one micro-batch into accepted, duplicate and late rows.

    The watermark is the newest time of the batches before, less ``delay``; a row behind it
    is late, a row without a time never.  Of rows with one key the first in time
    is accepted, unless an accepted row of the last ``2 * delay`` has the key: that is all the
    state, read by date.  Each folder of a batch id is written as a whole and the counts last,
    so a replayed batch changes nothing.
    """
    spark = batch.sparkSession
    newest = overlap_counts(spark, root).where(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
    mark = None if newest is None else newest - delay
    rows = batch.withColumn(EVENT_DATE, F.to_date(ts_ntz))
    is_late = F.lit(False) if mark is None else F.coalesce(F.col(ts_ntz) < C.ntz_literal(mark), F.lit(False))
    columns = sorted(batch.columns)
    on_time = dedup.keep_first(rows.where(~is_late), keys, [F.col(ts_ntz).asc_nulls_last(), F.xxhash64(*columns), *columns])
    if mark is not None:
        recent = F.col(EVENT_DATE).isNull() | (F.col(EVENT_DATE) >= F.lit((mark - delay).date()))
        schema = T.StructType([*[batch.schema[k] for k in keys], T.StructField("batch_id", T.LongType()), T.StructField(EVENT_DATE, T.DateType())])
        known = spark.read.schema(schema).parquet(f"{root}/{ACCEPTED}").where((F.col("batch_id") < batch_id) & recent)
        on_time = on_time.join(known.select(*keys), list(keys), "left_anti")
    for table, part in ((ACCEPTED, on_time), (LATE, rows.where(is_late))):
        path = f"{root}/{table}/batch_id={batch_id}"
        part.select(*batch.columns, EVENT_DATE).write.mode("overwrite").partitionBy(EVENT_DATE).parquet(path)

    def written(table: str) -> DataFrame:
        return spark.read.schema(batch.schema).parquet(f"{root}/{table}/batch_id={batch_id}").select(*batch.columns)

    if store is not None:
        insert_ignore_batch(written(ACCEPTED).unionByName(written(LATE)), store)
    n = F.count(F.lit(1))
    accepted, late = (written(t).select(n).scalar() for t in (ACCEPTED, LATE))
    counts = rows.agg(n.alias("input_rows"), F.max(ts_ntz).alias("newest")).select(
        "input_rows", accepted.alias("accepted"), (F.col("input_rows") - accepted - late).alias("duplicates"), late.alias("late"), "newest")
    counts.write.mode("overwrite").parquet(f"{root}/{COUNTS}/batch_id={batch_id}")


def stream_overlap(spark: SparkSession, landing_glob: str, schema: T.StructType, root: str, checkpoint: str,
                   overlap_days: int = S.OVERLAP_DAYS, keys: tuple[str, ...] = ("duplicate_key",), ts_ntz: str = "created_at",
                   files_per_trigger: int | None = None, store: str | None = None) -> DataFrame:
    """I9 without loss: drain the landed files and return the counts per micro-batch.

    With ``store`` accepted and late rows are inserted there first-wins (I8), duplicates by key included.
    """
    delay = dt.timedelta(days=overlap_days)
    q = (
        _landed_files(spark, landing_glob, schema, files_per_trigger).writeStream
        .foreachBatch(lambda df, n: overlap_batch(df, n, root, keys, ts_ntz, delay, store))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return overlap_counts(spark, root)
