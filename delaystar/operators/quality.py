"""Source audit (C11) and warehouse quality checks.

Each check is one pass: many ``count_if`` in a single aggregate (partial +
final), duplicate reports are ``groupBy(key).count() > 1`` per table, and scalar
counts combine through scalar subqueries instead of cross joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaystar import settings as S
from delaystar.functions import columns as C
from delaystar.operators.warehouse import Warehouse, usable_filter


def _count_if(cond) -> F.Column:
    return F.count_if(cond).cast("bigint")


# A16 / U1
def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_name")


def _distribution() -> list[F.Column]:
    return [
        F.count(F.lit(1)).alias("observations"),
        F.min("created_at").alias("first_observed_at"),
        F.max("created_at").alias("last_observed_at"),
        F.min("delay_seconds").cast("bigint").alias("min_delay_seconds"),
        F.max("delay_seconds").cast("bigint").alias("max_delay_seconds"),
        C.rounded_mean(F.sum("delay_seconds"), F.count("delay_seconds"), divisor_seconds=1).alias("avg_delay_seconds"),
    ]


# A9
def source_distribution(observations: DataFrame) -> DataFrame:
    return observations.agg(*_distribution())


def _missing(col: str) -> F.Column:
    return F.col(col).isNull() | (F.col(col) == "")


def _mandatory_counters() -> list[F.Column]:
    return [
        _count_if(F.col("observation_id").isNull()).alias("missing_id"),
        _count_if(_missing("route_id")).alias("missing_route_id"),
        _count_if(_missing("stop_id")).alias("missing_stop_id"),
        _count_if(_missing("direction_id")).alias("missing_direction_id"),
        _count_if(F.col("created_at").isNull()).alias("missing_created_at"),
        _count_if(F.col("scheduled_departure").isNull()).alias("missing_scheduled_departure"),
        _count_if(F.col("predicted_departure").isNull()).alias("missing_predicted_departure"),
        _count_if(F.col("delay_seconds").isNull()).alias("missing_delay_seconds"),
        _count_if(F.col("delay_seconds") < 0).alias("negative_delay_seconds"),
    ]


# Nine counters in one pass
def mandatory_field_audit(observations: DataFrame) -> DataFrame:
    return observations.agg(*_mandatory_counters())


# Left joins against the (small) route/stop tables, unmatched counted
def join_coverage(observations: DataFrame, routes: DataFrame, stops: DataFrame) -> DataFrame:
    r = routes.select(F.col("id").alias("route_id"), F.lit(True).alias("_route_found"))
    s = stops.select(F.col("id").alias("stop_id"), F.lit(True).alias("_stop_found"))
    joined = observations.select("route_id", "stop_id").join(r, "route_id", "left").join(s, "stop_id", "left")
    return joined.agg(
        _count_if(F.col("_route_found").isNull()).alias("observations_without_route"),
        _count_if(F.col("_stop_found").isNull()).alias("observations_without_stop"),
    )


# Latest observations (missing timestamps last, id breaks ties)
def audit_preview(observations: DataFrame, limit: int = S.AUDIT_PREVIEW_LIMIT) -> DataFrame:
    return observations.orderBy(F.col("created_at").desc_nulls_last(), F.col("observation_id").asc()).limit(limit) \
        .select(
            "observation_id", "route_id", "stop_id", "direction_id", "headsign", "stop_sequence",
            F.col("created_at").alias("observed_at"), "scheduled_departure", "predicted_departure",
            "delay_seconds", "delay_category",
        )


# Q10: declared columns of the source tables with the NULLs that the data has in them
def schema_audit(tables: dict[str, tuple[DataFrame, T.StructType]]) -> DataFrame:
    """Order, names and nullability come from the declared schemas, not from the frames; one pass per table."""
    parts = []
    for name, (df, declared) in tables.items():
        counts = df.agg(*[_count_if(F.col(f"`{f.name}`").isNull()).alias(f"c{i}") for i, f in enumerate(declared.fields)])
        parts.append(counts.select(
            F.lit(name).alias("table_name"),
            F.inline(F.array(*[
                F.struct(
                    F.lit(i + 1).alias("ordinal_position"),
                    F.lit(f.name).alias("column_name"),
                    F.lit("YES" if f.nullable else "NO").alias("is_nullable"),
                    F.col(f"c{i}").alias("null_count"),
                )
                for i, f in enumerate(declared.fields)
            ])),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_name", "ordinal_position")


# Two scalar counts in one row (uncorrelated scalar subqueries)
def reconcile_counts(spark: SparkSession, raw: DataFrame, fact: DataFrame) -> DataFrame:
    usable = usable_filter(raw).select(F.count(F.lit(1))).scalar()
    facts = fact.select(F.count(F.lit(1))).scalar()
    return spark.range(1).select(usable.alias("usable_raw_rows"), facts.alias("fact_rows"))


# A10 / U2 / Q9
def duplicate_key_report(wh: Warehouse) -> DataFrame:
    def dupes(df: DataFrame, key: str, issue: str) -> DataFrame:
        return (
            df.groupBy(key).count().filter(F.col("count") > 1)
            .agg(F.count(F.lit(1)).alias("issue_count"))
            .select(F.lit(issue).alias("issue"), "issue_count")
        )

    return (
        dupes(wh.fact, "source_observation_id", "duplicate_fact_ids")
        .unionByName(dupes(wh.dim_route, "route_key", "duplicate_route_keys"))
        .unionByName(dupes(wh.dim_stop, "stop_key", "duplicate_stop_keys"))
        .unionByName(dupes(wh.dim_date, "date_key", "duplicate_date_keys"))
    )


def joined_to_dims(wh: Warehouse) -> DataFrame:
    """The fact left-joined to one row per key of the three dimensions (a repeated key counts no fact twice)."""
    d = wh.dim_date.select("date_key").distinct().withColumn("_d", F.lit(True))
    r = wh.dim_route.select("route_key").distinct().withColumn("_r", F.lit(True))
    s = wh.dim_stop.select("stop_key").distinct().withColumn("_s", F.lit(True))
    return wh.fact.join(d, "date_key", "left").join(r, "route_key", "left").join(s, "stop_key", "left")


def issue_counters(zone: str) -> list[F.Column]:
    local_hour = C.local_hour("observed_at", zone)
    return [
        _count_if(F.col("source_observation_id").isNull()).alias("missing_observation_id"),
        _count_if(F.col("_d").isNull()).alias("unresolved_date"),
        _count_if(F.col("_r").isNull()).alias("unresolved_route"),
        _count_if(F.col("_s").isNull()).alias("unresolved_stop"),
        _count_if(F.col("delay_seconds").isNull() | (F.col("delay_seconds") < 0)).alias("invalid_delay"),
        _count_if(F.col("observed_at").isNull()).alias("missing_observed_at"),
        _count_if(F.col("date_key") != C.date_key("observed_at", zone)).alias("local_date_mismatch"),
        _count_if(F.col("time_period").isNull() | (F.col("time_period") != C.time_period(local_hour)))
        .alias("local_time_period_mismatch"),
    ]


# Q2..Q8 / J5: one pass over the fact left-joined to the three dimensions
def warehouse_issue_row(wh: Warehouse, zone: str = S.LOCAL_ZONE) -> DataFrame:
    return joined_to_dims(wh).agg(*issue_counters(zone))


# Per fact row, which dimension keys resolve (left joins on the key names)
def dim_resolution(wh: Warehouse) -> DataFrame:
    d = wh.dim_date.select("date_key", F.lit(True).alias("_d"))
    r = wh.dim_route.select("route_key", F.lit(True).alias("_r"))
    s = wh.dim_stop.select("stop_key", F.lit(True).alias("_s"))
    f = wh.fact.select("source_observation_id", "date_key", "route_key", "stop_key")
    return f.join(d, "date_key", "left").join(r, "route_key", "left").join(s, "stop_key", "left").select(
        "source_observation_id", "date_key", "route_key", "stop_key",
        F.col("_d").isNotNull().alias("date_resolved"),
        F.col("_r").isNotNull().alias("route_resolved"),
        F.col("_s").isNotNull().alias("stop_resolved"),
    )


# C11: the source audit as one row (one aggregate pass + one join-coverage pass)
def source_audit(observations: DataFrame, routes: DataFrame, stops: DataFrame) -> DataFrame:
    coverage = join_coverage(observations, routes, stops)
    found = coverage.select(F.struct(*coverage.columns)).scalar()
    one = observations.agg(*_distribution(), *_mandatory_counters()).withColumn("_coverage", found)
    return one.select("*", "_coverage.*").drop("_coverage")


# Every warehouse check as one row (Q1, Q2..Q8 in one pass, Q9 per table)
def warehouse_checks(spark: SparkSession, raw: DataFrame, wh: Warehouse) -> DataFrame:
    usable = usable_filter(raw).select(F.count(F.lit(1))).scalar()

    def dupes(df: DataFrame, key: str) -> F.Column:
        return df.groupBy(key).count().select(F.count_if(F.col("count") > 1)).scalar()

    issues = joined_to_dims(wh).agg(F.count(F.lit(1)).alias("fact_rows"), *issue_counters(wh.zone))
    return issues.select(
        usable.alias("usable_raw_rows"), "fact_rows",
        dupes(wh.fact, "source_observation_id").alias("duplicate_fact_ids"),
        dupes(wh.dim_route, "route_key").alias("duplicate_route_keys"),
        dupes(wh.dim_stop, "stop_key").alias("duplicate_stop_keys"),
        dupes(wh.dim_date, "date_key").alias("duplicate_date_keys"),
        *[c for c in issues.columns if c != "fact_rows"],
    )
