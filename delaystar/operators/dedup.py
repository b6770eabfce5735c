"""Deduplication, upserts and insert-ignore as set-based DataFrame operations.

First-wins and last-wins are both ``row_number() == 1`` over the key.  Spark
plans that filter with a partial ``WindowGroupLimit`` before the shuffle, so a
hot key contributes at most one row per map task to the exchange: skewed keys
never pile up in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaystar.session import dimension
from delaystar.sources.testdata import TIE_COLUMNS


def arrival_order(ts: str = "created_at", ties: Sequence[str] = TIE_COLUMNS) -> list[Column]:
    """Ascending arrival order; a missing timestamp sorts last."""
    return [F.col(ts).asc_nulls_last(), *[F.col(t).asc() for t in ties]]


def latest_order(ts: str = "created_at", ties: Sequence[str] = TIE_COLUMNS) -> list[Column]:
    """Descending arrival order; a missing timestamp sorts last."""
    return [F.col(ts).desc_nulls_last(), *[F.col(t).desc() for t in ties]]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order`` (W1/W2 core)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedup_first_by_key(observations: DataFrame, key: str = "duplicate_key") -> DataFrame:
    """First observation per natural key wins (insert-ignore semantics)."""
    return keep_first(observations, [key], arrival_order())


def dedup_latest_by_id(observations: DataFrame, key: str = "observation_id") -> DataFrame:
    """Latest observation per id wins (batch dedup before a MERGE)."""
    return keep_first(observations, [key], latest_order())


def insert_ignore(
    target: DataFrame, batch: DataFrame, key: str = "duplicate_key", order: Sequence[Column] | None = None,
    key_time: str | None = "scheduled_departure", stored: bool = False,
) -> DataFrame:
    """Rows of ``batch`` that a unique-key insert would accept.

    In-batch duplicates: the first by arrival order wins.  Keys already in
    ``target`` are skipped (left anti join reading only the key column).  The
    natural key embeds ``key_time`` (the scheduled departure), so only target rows
    inside the batch's ``key_time`` range can match: the target is filtered on
    that range (bounds are scalar subqueries, evaluated at run time), which lets
    a store partitioned or clustered by that time skip everything else.  The bounds read the
    batch besides the insert, so it is written first, unless it is ``stored`` (cheap to read again).
    """
    bounded = bool(key_time) and key_time in target.columns and key_time in batch.columns
    if bounded and not stored:
        batch = dimension(batch)
    first = keep_first(batch, [key], order or arrival_order())
    known = target
    if bounded:
        lo = batch.select(F.min(key_time)).scalar()
        hi = batch.select(F.max(key_time)).scalar()
        known = target.filter(F.col(key_time).between(lo, hi))
        if "scheduled_date" in target.columns:  # store layout: prune partitions at run time
            known = known.filter(F.col("scheduled_date").between(F.to_date(lo), F.to_date(hi)))
    return first.join(known.select(key), on=key, how="left_anti")


def merge_by_id(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """I4: MERGE (update matched, insert new) of a batch already unique per ``key``.

    Target rows whose id the batch does not bring are kept, then the batch is added.
    Against a small batch the anti join broadcasts the batch's ids, so the target is
    scanned once and neither shuffled nor sorted.  Rows without an id stay.
    """
    kept = target.join(batch.select(key), on=key, how="left_anti")
    return kept.select(*target.columns).unionByName(batch.select(*target.columns))


def merge_days(target: DataFrame, batch: DataFrame, key: str, time: str) -> tuple[DataFrame, DataFrame]:
    """:func:`merge_by_id` in two parts: the target's days of ``time`` that hold no id of the batch, as they are,
    and the other days merged with the batch.

    The days come from a semi join of hashed ids, so against a batch above the broadcast threshold only
    hashes and the rows of the touched days are shuffled, and only these are to be written again.  Any row may lie on
    any day, also on none.  Both inputs are read more than once and should be stored.
    """
    dated = target.withColumn("_day", F.to_date(time))
    ids = [df.where(F.col(key).isNotNull()).withColumn("_id", F.xxhash64(key)) for df in (dated, batch)]  # equal hashes at most touch one more day
    holding = ids[0].select("_id", "_day").join(ids[1].select("_id"), "_id", "left_semi")
    days = dimension(holding.select(F.col("_day").alias("_touched")).distinct())
    on_day = F.col("_day").eqNullSafe(F.col("_touched"))
    kept = dated.join(days, on_day, "left_anti").select(*target.columns)
    return kept, merge_by_id(dated.join(days, on_day, "left_semi").select(*target.columns), batch, key)


def save_summary(batch: DataFrame, accepted: DataFrame, run: str = "collection_run_id") -> DataFrame:
    """Per batch (run) what an insert saves and skips.

    ``accepted`` comes from :func:`insert_ignore`.  Only counts are combined
    (partial aggregation on both sides), so a hot key never lands in one task.
    Routes and stops saved are the distinct entities of the batch.
    """
    # counted per (run, route, stop) first, so the distinct counts expand groups, not rows
    pairs = batch.groupBy(run, "route_id", "stop_id").agg(F.count(F.lit(1)).alias("_n"))
    totals = pairs.groupBy(run).agg(
        F.countDistinct("route_id").alias("routes_saved"),
        F.countDistinct("stop_id").alias("stops_saved"),
        F.sum("_n").alias("_rows"),
    )
    saved = accepted.groupBy(run).agg(F.count(F.lit(1)).alias("_saved"))
    j = totals.join(saved, run, "left").withColumn("_saved", F.coalesce("_saved", F.lit(0)))
    return j.select(
        run, "routes_saved", "stops_saved", F.lit(1).cast("bigint").alias("collection_runs_saved"),
        F.col("_saved").alias("delay_observations_saved"),
        (F.col("_rows") - F.col("_saved")).alias("duplicate_observations_skipped"),
        (F.col("routes_saved") + F.col("stops_saved") + 1 + F.col("_saved")).alias("total_saved"),
    )


def run_records_saved(runs: DataFrame, accepted: DataFrame, run: str = "collection_run_id") -> DataFrame:
    """``records_saved`` = inserted observations of each run (0 when none)."""
    counts = accepted.groupBy(F.col(run).alias("id")).agg(F.count(F.lit(1)).alias("_n"))
    return runs.drop("records_saved").join(counts, on="id", how="left").select(
        "id", "started_at", "finished_at", "status",
        F.coalesce("_n", F.lit(0)).cast("int").alias("records_saved"), "error_message",
    )
