"""Operational tables derived from the shared test parquet (``lineitem``).

Every row of ``lineitem`` becomes one collected departure observation; repeated
``(l_orderkey, l_linenumber)`` pairs become repeated observations of one
departure, so deduplication has real work.  The derivation is a pure projection
(no shuffle), so it scales with the input and keeps parquet column pruning.

Rules of the derivation (they define the test data, so both engines share them):
route by order key modulo 5 (suppliers divisible by 97 get an unknown route),
stop by ``(order + 3 * line) mod 20``, schedule offset by order, created-at
jittered by part key, delay from quantity and line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaystar.functions import identity

EPOCH_2024 = "2024-01-01 00:00:00"

# Fixture lookup values (define the test data).
ROUTE_BY_ORDER_MOD5 = ("R_3040", "R_3060", "R_0070", "R_1050", "R_5100")
UNKNOWN_ROUTE = "R_9999"
HEADSIGN_BY_ORDER_MOD6 = (
    "",
    None,
    "Újbuda-központ M",
    "Móricz Zsigmond körtér M",
    "Széll Kálmán tér M",
    "Mexikói út M",
)
ROUTES = (
    ("R_3040", "4", "TRAM"),
    ("R_3060", "6", "TRAM"),
    ("R_0070", "7", "BUS"),
    ("R_1050", "105", "BUS"),
    ("R_5100", "M1", "SUBWAY"),
)
STOP_COUNT = 20

TIE_COLUMNS = ("tie_1", "tie_2", "tie_3", "tie_4")


def _base_ts() -> F.Column:
    return F.lit(EPOCH_2024).cast("timestamp_ntz")


def _plus_seconds(seconds: F.Column) -> F.Column:
    return F.timestamp_add("SECOND", seconds, _base_ts())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All collected observations (duplicates included) with tie-break columns."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    off = (ok % 360) * 86400 + (ok * 7919) % 86400
    ds = F.when(ok % 211 == 0, F.lit(None).cast("bigint")).otherwise(
        F.col("l_quantity").cast("bigint") * 12 - 120 + ln
    )
    li = li.select("*", off.alias("off"), ds.alias("ds"))

    route = F.when(F.col("l_suppkey") % 97 == 0, F.lit(UNKNOWN_ROUTE))
    for i, rid in enumerate(ROUTE_BY_ORDER_MOD5):
        route = route.when(ok % 5 == i, F.lit(rid))
    headsign = F.when(ok % 6 == 0, F.lit(HEADSIGN_BY_ORDER_MOD6[0]))
    for i, h in enumerate(HEADSIGN_BY_ORDER_MOD6[1:], start=1):
        headsign = headsign.when(ok % 6 == i, F.lit(h).cast("string"))
    stop_id = F.concat(F.lit("S_"), ((ok + ln * 3) % STOP_COUNT).cast("string"))
    trip_id = F.concat(F.lit("T_"), ok.cast("string"))
    scheduled = _plus_seconds(F.col("off"))
    created = F.when(ok % 199 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
        _plus_seconds(F.col("off") + F.col("l_partkey") % 3600 - 1800)
    )
    d = F.col("ds")
    category = (
        F.when(d < -60, "early")
        .when(d <= 60, "on_time")
        .when(d <= 180, "minor_delay")
        .when(d <= 360, "medium_delay")
        .when(d > 360, "major_delay")
    )
    return li.select(
        F.concat(F.lit("O_"), ok.cast("string"), F.lit("_"), ln.cast("string")).alias("observation_id"),
        F.concat(F.lit("RUN_"), (ok % 360).cast("string")).alias("collection_run_id"),
        route.alias("route_id"),
        stop_id.alias("stop_id"),
        trip_id.alias("trip_id"),
        headsign.alias("headsign"),
        F.when(ok % 50 == 0, F.lit("")).otherwise((ln % 2).cast("string")).alias("direction_id"),
        ln.alias("stop_sequence"),
        scheduled.alias("scheduled_departure"),
        _plus_seconds(F.col("off") + F.coalesce(d, F.lit(0))).alias("predicted_departure"),
        created.alias("created_at"),
        d.alias("delay_seconds"),
        category.alias("delay_category"),
        identity.duplicate_key(trip_id, stop_id, scheduled).alias("duplicate_key"),
        F.col("l_partkey").alias("tie_1"),
        F.col("l_suppkey").alias("tie_2"),
        F.col("l_quantity").alias("tie_3"),
        F.col("l_extendedprice").alias("tie_4"),
    )


def routes(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    """The five observed routes (R_9999 in the data is unknown on purpose) and one route per ``supplier``."""
    observed = spark.createDataFrame(list(ROUTES), "id string, short_name string, route_type string")
    if sf_dir is None:
        return observed
    key = F.col("s_suppkey")
    kind = F.when(F.col("s_nationkey") % 3 == 0, "BUS").when(F.col("s_nationkey") % 3 == 1, "TRAM").otherwise("TROLLEY")
    return observed.unionByName(read_table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("R_S"), key.cast("string")).alias("id"),
        F.concat(F.lit("S"), key.cast("string")).alias("short_name"),
        kind.alias("route_type"),
    ))


def stops(spark: SparkSession, sf_dir: str | None = None) -> DataFrame:
    """The observed stops S_0..S_19 (two ids share a name; S_19 has no coordinates) and one stop per ``part``."""
    observed = _observed_stops(spark)
    if sf_dir is None:
        return observed
    key = F.col("p_partkey")
    place = lambda base, n: F.when(key % 50 != 0, F.lit(base) + (key % n).cast("double") / F.lit(1000.0))
    return observed.unionByName(read_table(spark, sf_dir, "part").select(
        F.concat(F.lit("S_P"), key.cast("string")).alias("id"),
        F.col("p_name").alias("name"),
        place(47.0, 1000).alias("lat"),
        place(19.0, 777).alias("lon"),
    ))


def _observed_stops(spark: SparkSession) -> DataFrame:
    i = F.col("id")
    return spark.range(STOP_COUNT).select(
        F.concat(F.lit("S_"), i.cast("string")).alias("id"),
        F.concat(F.lit("Stop "), F.floor(i / 2).cast("bigint").cast("string")).alias("name"),
        F.when(i == STOP_COUNT - 1, F.lit(None)).otherwise(F.lit(47.4) + i / 1000.0).cast("double").alias("lat"),
        F.when(i == STOP_COUNT - 1, F.lit(None)).otherwise(F.lit(19.0) + i / 1000.0).cast("double").alias("lon"),
    )


def collection_runs(observations: DataFrame) -> DataFrame:
    """One run per collection_run_id: first and last creation time (partial aggregation)."""
    return observations.groupBy("collection_run_id").agg(
        F.min("created_at").alias("started_at"),
        F.max("created_at").alias("finished_at"),
    ).select(
        F.col("collection_run_id").alias("id"),
        "started_at",
        "finished_at",
        F.lit("success").alias("status"),
        F.lit(0).alias("records_saved"),
        F.lit("").alias("error_message"),
    )
