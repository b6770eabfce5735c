"""Incremental load with a late-data overlap (I1..I7, C13).

A cycle extracts the last ``OVERLAP_DAYS`` of observations (I1), keeps the
latest row per id (I3), merges the batch into the raw history and the fact by
id with the batch winning (I4), extends the date dimension with missing days
only (I5) and re-runs the checks before a cycle may be logged (I6).  Rerunning
the same window changes nothing (I7).

Scale notes: the merge keeps the target rows whose id the batch does not bring
(anti join; a small batch is broadcast, so the target is not shuffled) and adds
the batch.  When the target is stored partitioned by date, only the touched
partitions are read and rewritten (dynamic partition overwrite).
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaystar import settings as S
from delaystar.functions import columns as C
from delaystar.operators import dedup, warehouse
from delaystar.session import dimension
from delaystar.sources import snapshots


def overlap_extract(raw: DataFrame, as_of: dt.datetime, days: int = S.OVERLAP_DAYS) -> DataFrame:
    """Observations created in ``[as_of - days, as_of]`` (as_of is a parameter, not now())."""
    lo = C.ntz_literal(as_of - dt.timedelta(days=days))
    hi = C.ntz_literal(as_of)
    return raw.filter((F.col("created_at") >= lo) & (F.col("created_at") <= hi))


def batch_dedup(batch: DataFrame) -> DataFrame:
    """Latest row per observation id."""
    return dedup.dedup_latest_by_id(batch, "observation_id")


def merge_raw(target: DataFrame, batch: DataFrame) -> DataFrame:
    """I4 (raw): update matched ids, insert new ones; ``batch`` is unique per id."""
    return dedup.merge_by_id(target, batch, "observation_id")


def extend_dim_date(dim_date: DataFrame, raw: DataFrame, zone: str = S.LOCAL_ZONE) -> DataFrame:
    """Existing days plus the days of ``raw`` that are missing (never rebuilt)."""
    days = raw.filter(F.col("created_at").isNotNull()).select(
        F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), "created_at")).alias("calendar_date")
    ).distinct()
    missing = days.join(dim_date.select("calendar_date"), on="calendar_date", how="left_anti")
    return dim_date.unionByName(missing.select(*warehouse.calendar_attributes("calendar_date")))


def merge_fact(fact: DataFrame, batch_fact: DataFrame) -> DataFrame:
    """I4 (fact): merge by ``source_observation_id``."""
    return dedup.merge_by_id(fact, batch_fact, "source_observation_id")


def merge_fact_partitions(
    fact_path: str, batch_fact: DataFrame, key: str = "source_observation_id", located_by: str | None = None
) -> None:
    """I4 on the stored fact: rewrite only the UTC-date partitions the merge touches.

    Touched partitions are the batch's dates plus every date that currently
    holds one of the batch's ids (found with a semi join on a two-column scan),
    so a re-delivered row whose day changed leaves no stale copy behind.  With
    ``located_by`` (the scheduled departure, which an observation's id fixes) that scan opens
    only the dates that the fact's index lists for the batch's scheduled days; the fact
    must have been written with it.  Dates are compared null-safely.  The merged slice is
    checkpointed before the dynamic partition overwrite, so the job never overwrites files it
    is still reading.  A touched date that keeps no row is removed after the write, as an
    overwrite writes nothing there.
    """
    from delaystar.session import dimension, materialize
    from delaystar.sources import sinks

    spark = batch_fact.sparkSession
    batch = materialize(batch_fact.withColumn("observed_date", F.to_date("observed_at")))
    stored = sinks.read_fact(spark, fact_path)

    def on_dates(dates: DataFrame) -> DataFrame:
        days = dates.select(F.col("observed_date").alias("_day"))
        # equality keeps dynamic partition pruning; the null date, if any, is a slice of its own
        dated = stored.join(days, F.col("observed_date") == F.col("_day"), "left_semi")
        if not dates.where("observed_date IS NULL").isEmpty():
            dated = dated.unionByName(stored.where("observed_date IS NULL"))
        return dated

    searched = stored if located_by is None else on_dates(dimension(sinks.dates_located(spark, fact_path, batch, located_by)))
    holding = searched.select(key, "observed_date").join(batch.select(key), key, "left_semi").select("observed_date")
    dates = dimension(holding.unionByName(batch.select("observed_date")).distinct())
    # an empty batch touches no date: the overwrite below then writes nothing
    merged = materialize(dedup.merge_by_id(on_dates(dates), batch, key))
    sinks.write_fact_partitioned(merged, fact_path, mode="overwrite", located_by=located_by)
    left = merged.select(F.col("observed_date").alias("_day")).distinct()
    emptied = dates.join(left, F.col("observed_date").eqNullSafe(F.col("_day")), "left_anti")
    sinks.drop_partitions(spark, fact_path, "observed_date", [r[0] for r in emptied.collect()])


@dataclass(frozen=True)
class CycleResult:
    """The tables after a cycle; ``target`` and ``raw_target`` are those before it, the batch's parts are stored.

    A merge looks for the days that hold the batch's ids when its table is first asked for.
    """

    target: warehouse.Warehouse
    raw_target: DataFrame
    batch: DataFrame
    batch_fact: DataFrame
    dim_date: DataFrame
    dim_route: DataFrame
    dim_stop: DataFrame

    @cached_property
    def _raw_parts(self) -> tuple[DataFrame, DataFrame]:
        return dedup.merge_days(self.raw_target, self.batch, "observation_id", LOCATED_BY)

    @cached_property
    def _fact_parts(self) -> tuple[DataFrame, DataFrame]:
        return dedup.merge_days(self.target.fact, self.batch_fact, "source_observation_id", LOCATED_BY)

    @cached_property
    def raw(self) -> DataFrame:
        kept, merged = self._raw_parts
        return kept.unionByName(merged)

    @cached_property
    def fact(self) -> DataFrame:
        kept, merged = self._fact_parts
        return kept.unionByName(merged)

    @property
    def wh(self) -> warehouse.Warehouse:
        return warehouse.Warehouse(self.dim_date, self.dim_route, self.dim_stop, self.fact, self.target.zone)

    def store(self) -> tuple[DataFrame, DataFrame]:
        """(raw, fact) with the merged days written; the others stay where the targets hold them."""
        (raw_kept, raw), (fact_kept, fact) = self._raw_parts, self._fact_parts
        return raw_kept.unionByName(dimension(raw)), fact_kept.unionByName(dimension(fact))


def incremental_cycle(
    wh: warehouse.Warehouse,
    raw_target: DataFrame,
    batch: DataFrame,
    routes: DataFrame,
    stops: DataFrame,
) -> CycleResult:
    """C13 up to the fact: I3 -> I4 raw -> I5 -> C5 -> C6 on the batch -> I4 fact."""
    unique_batch = dimension(batch_dedup(batch))  # used by the raw merge, the dates and the fact
    dim_date = extend_dim_date(wh.dim_date, unique_batch, wh.zone)
    dim_route = dimension(warehouse.build_dim_route(routes))
    dim_stop = dimension(warehouse.build_dim_stop(stops))
    batch_fact = dimension(warehouse.build_fact(unique_batch, dim_route, dim_stop, wh.zone, stored=True))
    return CycleResult(wh, raw_target, unique_batch, batch_fact, dim_date, dim_route, dim_stop)


RAW, FACT, DIMENSIONS = "raw", "fact", ("dim_date", "dim_route", "dim_stop")
RAW_DAY, FACT_DAY = "scheduled_date", "observed_date"
#: Clustering of a stored day, and the time that an observation's id fixes (its key text holds it).
RAW_ORDER, FACT_ORDER = ("observation_id",), ("route_key", "stop_key", "source_observation_id")
LOCATED_BY = "scheduled_departure"


def _raw_with_day(raw: DataFrame) -> DataFrame:
    return raw.withColumn(RAW_DAY, F.to_date(LOCATED_BY))


def _fact_with_day(fact: DataFrame) -> DataFrame:
    return fact.withColumn(FACT_DAY, F.to_date("observed_at"))


def warehouse_of(tables: snapshots.TableSet, zone: str = S.LOCAL_ZONE) -> warehouse.Warehouse:
    """The star schema of a published (or proposed) set; the fact keeps its UTC date for pruning."""
    return warehouse.Warehouse(*(tables.table(t) for t in DIMENSIONS), tables.table(FACT), zone)


def initial_load(root: str, wh: warehouse.Warehouse, raw: DataFrame, version: str = "initial") -> snapshots.TableSet:
    """Publish a built warehouse and its raw history as the set that cycles start from."""
    from delaystar.operators import partition_checks

    parent = snapshots.published(raw.sparkSession, root)
    staged = snapshots.stage(_raw_with_day(raw), root, RAW, version, by=RAW_DAY, order=RAW_ORDER, newest_of="created_at")
    for name in DIMENSIONS:
        staged += snapshots.stage(getattr(wh, name), root, name, version)
    staged += snapshots.stage(_fact_with_day(wh.fact), root, FACT, version, by=FACT_DAY, order=FACT_ORDER, located_by=LOCATED_BY)
    tables = snapshots.empty_set(raw.sparkSession, root).with_staged(staged)
    _, tables = partition_checks.stage_checks(tables, snapshots.empty_set(raw.sparkSession, root), version, wh.zone)
    return snapshots.publish(tables, parent, version)


@dataclass(frozen=True)
class CycleOutcome:
    """``log``: the control table; ``tables``: the set in service after the cycle; ``proposed``: what was audited."""

    log: DataFrame
    tables: snapshots.TableSet
    proposed: snapshots.TableSet
    succeeded: bool


def propose_cycle(
    parent: snapshots.TableSet, batch: DataFrame, routes: DataFrame, stops: DataFrame, version: str, zone: str = S.LOCAL_ZONE
) -> snapshots.TableSet:
    """C13 up to the audit: the batch merged into ``parent`` (I3, I4, I5, C5, C6), written as staged versions.

    An id's scheduled departure never changes, so the raw history is partitioned by the
    scheduled day and only the batch's days are merged.  The fact is partitioned by the UTC
    day of observation, which can change; the days that can hold one of the batch's ids come
    from the manifest, those that do hold one from a two-column scan of these only.
    """
    unique = dimension(_raw_with_day(batch_dedup(batch)))  # used by the raw merge, the dates and the fact
    days = snapshots.days_of(unique, RAW_DAY)
    merged = dedup.merge_by_id(parent.table(RAW, days), unique, "observation_id") if parent.of(RAW) else unique
    staged = snapshots.stage(merged, parent.root, RAW, version, by=RAW_DAY, order=RAW_ORDER, newest_of="created_at")

    dims = {"dim_route": dimension(warehouse.build_dim_route(routes)), "dim_stop": dimension(warehouse.build_dim_stop(stops))}
    dims["dim_date"] = (extend_dim_date(parent.table("dim_date"), unique, zone) if parent.of("dim_date")
                        else warehouse.build_dim_date(unique, zone))
    for name, df in dims.items():
        staged += snapshots.stage(df, parent.root, name, version)

    key = "source_observation_id"
    new = dimension(_fact_with_day(warehouse.build_fact(unique, dims["dim_route"], dims["dim_stop"], zone, stored=True)))
    touched = snapshots.days_of(new, FACT_DAY)
    if parent.of(FACT):
        searched = parent.table(FACT, parent.can_hold(FACT, snapshots.days_of(new, LOCATED_BY)) - touched)
        touched |= snapshots.days_of(searched.select(key, FACT_DAY).join(new.select(key), key, "left_semi"), FACT_DAY)
        new = dedup.merge_by_id(parent.table(FACT, touched), new, key)
    staged += snapshots.stage(new, parent.root, FACT, version, by=FACT_DAY, order=FACT_ORDER, located_by=LOCATED_BY)
    return parent.with_staged(staged, {FACT: touched, RAW: days})


def run_cycle(
    root: str, batch: DataFrame, routes: DataFrame, stops: DataFrame, cycle_id: str | None = None, zone: str = S.LOCAL_ZONE
) -> CycleOutcome:
    """Write, audit, publish.  The batch is merged into staged versions, C12 runs on what was written (the
    days that the cycle touched; the others' counters are kept), and only a set that passes every
    check is published, all tables by one commit; then the outcome is logged (I6).

    A failed or interrupted cycle leaves the former set in service.  Rerunning a published
    batch proposes the digests already in place, so its commit changes no table (I7).
    """
    from delaystar.operators import partition_checks
    from delaystar.sources import sinks

    spark = batch.sparkSession
    cycle_id = cycle_id or uuid.uuid4().hex
    parent = snapshots.published(spark, root)
    version = f"{cycle_id}-{uuid.uuid4().hex[:8]}"
    checks, proposed = partition_checks.stage_checks(propose_cycle(parent, batch, routes, stops, version, zone), parent, version, zone)
    succeeded = sinks.cycle_outcome(checks, cycle_id).first()["status"] == "success"
    tables = snapshots.publish(proposed, parent, cycle_id) if succeeded else parent
    return CycleOutcome(sinks.log_cycle(checks, f"{root}/etl_control", cycle_id), tables, proposed, succeeded)


#: Groups of keys whose sums two runs are first compared by.
KEY_GROUPS = 1024


def rerun_differences(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """One row with the rows that differ between two runs and duplicate keys left.

    Every row of both runs is hashed.  The hashes are summed by groups of keys first, which sends a row per task and
    group; only the keys of groups whose sums differ are compared one by one.  Rows without a key match none.
    """
    group = F.when(F.col(key).isNotNull(), F.pmod(F.xxhash64(key), F.lit(KEY_GROUPS))).alias("_group")

    def side(df: DataFrame, sign: int) -> DataFrame:
        digest = F.xxhash64(*df.columns).cast("decimal(38,0)") * sign
        return df.select(key, group, digest.cast("decimal(38,0)").alias("_digest"), F.lit(int(sign > 0)).cast("bigint").alias("_a"),
                         F.lit(int(sign < 0)).cast("bigint").alias("_b"))

    both = side(first, 1).unionByName(side(second, -1))
    sums = [F.sum(c).alias(c) for c in ("_digest", "_a", "_b")]
    differ = dimension(both.groupBy("_group").agg(*sums).where("_digest <> 0 OR _a <> _b OR _group IS NULL"))
    keys = both.join(differ.select("_group"), "_group", "left_semi").groupBy(key).agg(*sums)
    changed = keys.where("_digest <> 0 OR (_a = 0) <> (_b = 0)").unionByName(differ.where("_group IS NULL").drop("_group"), allowMissingColumns=True)
    repeats = second.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return changed.agg(F.coalesce(F.sum(F.col("_a") + F.col("_b")), F.lit(0)).cast("bigint").alias("differing_rows")).crossJoin(
        repeats.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("fact_rows"),
                    F.count_if(F.col("_n") > 1).cast("bigint").alias("duplicate_ids")))
