"""Payload files as a stream (S1, C1, C3, I8): runs, routes, stops, observations and error rows per micro-batch.

A landed file is text.  Either each line is an envelope (JSON with the payload's id, run,
requested stop, fetch time and raw ``body``), or, with ``whole_files``, a file is one body and its
path says the rest: ``.../<collection run>/<stop>/<payload id>.json``.

Every micro-batch is written below one batch id: ``<root>/<table>/batch_id=<n>/``, each folder
overwritten as a whole, and a marker last.  A batch that is replayed after a failure so writes
the same folders again, and readers see batches up to the newest marker only, so a batch
is seen with all its tables or not at all.  Observations are inserted first-wins
against the batches already in the store, of which only the scheduled days of the batch
are read; entities keep every batch's version and the last one counts when they are read.
Nothing is dropped: what cannot be read as an envelope, is not JSON, or carries another status
than OK is a row of ``quarantine`` with its text, its file and the reason.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaystar import settings as S
from delaystar.functions import columns as C
from delaystar.operators import dedup, ingest
from delaystar.session import dimension
from delaystar.sources import sinks

ENVELOPE = "payload_id string, collection_run_id string, trip_id string, stop_id string, fetched_at timestamp_ntz, body string"
BAD_ENVELOPE = "bad envelope"
BATCH, MARKERS, SCHEDULED_DATE = "batch_id", "_batches", "scheduled_date"

OBSERVATION = (
    "payload_id string, observation_id string, collection_run_id string, route_id string, stop_id string, trip_id string, "
    "headsign string, direction_id string, stop_sequence bigint, scheduled_departure timestamp_ntz, "
    "predicted_departure timestamp_ntz, delay_seconds bigint, delay_category string, created_at timestamp_ntz, "
    "duplicate_key string, position int, collection_id string, scheduled_date date"
)
SCHEMAS = {
    "delay_observations": OBSERVATION,
    "routes": "payload_id string, fetched_at timestamp_ntz, position int, id string, short_name string, route_type string",
    "stops": "payload_id string, fetched_at timestamp_ntz, position int, id string, name string, lat double, lon double",
    "collection_runs": "id string, started_at timestamp_ntz, finished_at timestamp_ntz, status string, records_saved int, error_message string",
    "quarantine": "payload_id string, collection_run_id string, stop_id string, fetched_at timestamp_ntz, error_message string, "
                  "body string, file string",
}


def land_payload_files(payloads: DataFrame, landing: str) -> None:
    """Write payloads as landed files of envelope lines, as they are dealt, gzipped (JSON shrinks about tenfold).

    No reader relies on an order of the files, so the bodies are not shuffled once more.
    """
    line = F.to_json(F.struct(*[f.name for f in T.StructType.fromDDL(ENVELOPE)]))
    payloads.select(line.alias("value")).write.mode("errorifexists").option("compression", "gzip").text(landing)


def envelopes(lines: DataFrame, whole_files: bool = False) -> DataFrame:
    """(``value``, ``file``) text rows -> envelope columns with ``line``, ``file`` and ``readable``."""
    if whole_files:
        parts = F.split("file", "/")
        at = lambda k: F.url_decode(F.element_at(parts, -k))
        return lines.select(
            F.regexp_replace(at(1), r"\.[^.]*$", "").alias("payload_id"), at(3).alias("collection_run_id"), F.lit(None).cast("string").alias("trip_id"),
            at(2).alias("stop_id"), F.col("arrived_at").alias("fetched_at"), F.col("value").alias("body"),
            F.col("value").alias("line"), "file", F.lit(True).alias("readable"))
    read = F.from_json("value", f"{ENVELOPE}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    rows = lines.select(read.alias("e"), F.col("value").alias("line"), "file").select("e.*", "line", "file")
    usable = F.col("_corrupt").isNull() & C.nonblank(F.col("payload_id")).isNotNull() & F.col("body").isNotNull()
    return rows.withColumn("readable", F.coalesce(usable, F.lit(False))).drop("_corrupt")


def committed(spark: SparkSession, root: str) -> int | None:
    """Newest batch id whose tables are all written."""
    try:
        return spark.read.schema("batch_id bigint").parquet(f"{root}/{MARKERS}").agg(F.max(BATCH)).first()[0]
    except AnalysisException as e:
        if not sinks.path_missing(e):
            raise
        return None


def batches(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of a table with their ``batch_id``, complete batches only."""
    last = committed(spark, root)
    schema = T.StructType.fromDDL(f"{SCHEMAS[table]}, {BATCH} bigint")
    if last is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{table}").where(F.col(BATCH) <= last)


def read_store(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the store: of routes and stops the version of the last payload, of runs that of the last batch."""
    rows = batches(spark, root, table)
    if table in ("routes", "stops"):
        empty = rows.limit(0).drop("payload_id", "fetched_at", "position", BATCH)
        return ingest.upsert_entities(empty, rows)
    if table == "collection_runs":
        return dedup.keep_first(rows, ["id"], [F.col(BATCH).desc()]).drop(BATCH)
    return rows.drop(BATCH, SCHEDULED_DATE)


def _write(df: DataFrame, root: str, table: str, batch_id: int, by: str | None = None) -> None:
    names = [f.name for f in T.StructType.fromDDL(SCHEMAS[table])]
    writer = df.select(*names).write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(f"{root}/{table}/{BATCH}={batch_id}")


def commit_batch(spark: SparkSession, root: str, batch_id: int) -> None:
    spark.range(1).select(F.lit(batch_id).cast("bigint").alias(BATCH)).coalesce(1).write.mode("overwrite").parquet(
        f"{root}/{MARKERS}/id={batch_id}")


def seed_store(observations: DataFrame, root: str) -> None:
    """Put observations collected before the stream into the store, as batch -1; columns they lack are null."""
    spark = observations.sparkSession
    dated = observations.withColumn(SCHEDULED_DATE, F.to_date("scheduled_departure"))
    for table, ddl in SCHEMAS.items():
        fields = T.StructType.fromDDL(ddl).fields
        rows = dated if table == "delay_observations" else spark.createDataFrame([], ddl)
        filled = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
        _write(filled, root, table, -1, SCHEDULED_DATE if table == "delay_observations" else None)
    commit_batch(spark, root, -1)


def load_batch(lines: DataFrame, batch_id: int, root: str, limit: int = S.COLLECTOR_DEPARTURE_LIMIT, whole_files: bool = False) -> None:
    """foreachBatch body: one micro-batch of text rows into the store."""
    spark = lines.sparkSession
    landed = envelopes(lines, whole_files)
    # read and parsed once for all tables; a line that is no envelope is refused like a payload without a body
    scanned = ingest.scan_payloads(landed).withColumns({
        "accepted": F.col("readable") & F.col("accepted"),
        "error_message": F.when(F.col("readable"), F.col("error_message")).otherwise(BAD_ENVELOPE),
        "body": F.when(F.col("readable"), F.col("body")).otherwise(F.col("line")),
    })
    rows = dimension(ingest.parse_payloads(scanned, limit, "body", "file"))
    refused = rows.where(~F.col("accepted"))
    _write(refused.withColumnsRenamed({"collection_id": "collection_run_id", "_requested": "stop_id"}), root, "quarantine", batch_id)

    parsed = rows.where("accepted")
    _write(ingest.parsed_routes(parsed), root, "routes", batch_id)
    _write(ingest.parsed_stops(parsed), root, "stops", batch_id)
    store = batches(spark, root, "delay_observations").where(F.col(BATCH) != batch_id)
    accepted = ingest.collect_parsed(store, parsed).withColumn(SCHEDULED_DATE, F.to_date("scheduled_departure"))
    _write(accepted, root, "delay_observations", batch_id, SCHEDULED_DATE)
    written = spark.read.schema(SCHEMAS["delay_observations"]).parquet(f"{root}/delay_observations/{BATCH}={batch_id}")
    saved = dedup.run_records_saved(ingest.parsed_runs(parsed), written, run="collection_run_id")
    _write(saved, root, "collection_runs", batch_id)
    commit_batch(spark, root, batch_id)


def stream_payloads(
    spark: SparkSession, landing: str, root: str, checkpoint: str, files_per_trigger: int | None = None,
    limit: int = S.COLLECTOR_DEPARTURE_LIMIT, whole_files: bool = False,
) -> None:
    """Drain the landed payload files (availableNow) into the store below ``root``."""
    reader = spark.readStream.format("text").option("wholetext", whole_files).option("recursiveFileLookup", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    arrived = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("_metadata.file_modification_time").cast("timestamp_ntz"))
    lines = reader.load(landing).select("value", F.col("_metadata.file_path").alias("file"), arrived.alias("arrived_at"))
    query = (
        lines.writeStream.foreachBatch(lambda df, n: load_batch(df, n, root, limit, whole_files))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
