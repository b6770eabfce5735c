"""C12 kept per partition: a cycle's audit reads the days that it touched (Q1..Q9 as mergeable counters).

All warehouse checks are sums over rows, so they are kept per day and version of a table
set (:mod:`delaystar.sources.snapshots`) and added up:

- raw days: usable rows (Q1);
- fact days: rows and the issue counters (Q1..Q8), which also depend on the dimensions;
- scheduled days: ids that repeat (Q9).  An id fixes its scheduled departure, so copies of
  an id are on one scheduled day, in the partitions that the manifest lists for it.

A day's counters are taken over from the parent set while its tag (the versions it was counted
on) is the same and, for the fact, the dimensions are the same or only grew and every
key of the day resolved.  The dimensions are small and checked whole.  The driver holds a
few counters per day.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaystar import settings as S
from delaystar.operators import quality
from delaystar.operators.warehouse import Warehouse, occurring, usable_filter
from delaystar.sources import snapshots

TABLE = "checks"
SCHEMA = "kind string, day string, tag string, name string, value bigint"
RAW, FACT, IDS = "raw", "fact", "ids"
KEY, LOCATED_BY = "source_observation_id", "scheduled_departure"
UNRESOLVED = ("unresolved_date", "unresolved_route", "unresolved_stop")
DIMENSION_KEYS = {"dim_date": "date_key", "dim_route": "route_key", "dim_stop": "stop_key"}

Counters = dict[tuple[str, str], tuple[str, dict[str, int]]]


def tags(tables: snapshots.TableSet) -> dict[tuple[str, str], str]:
    """What each day's counters depend on: its version, or those of all partitions that hold a scheduled day."""
    out = {(kind, day): e["version"] for kind in (RAW, FACT) for day, e in tables.of(kind).items()}
    holding: dict[str, list[str]] = {}
    for day, e in sorted(tables.of(FACT).items()):
        for located in e["located"] or ():
            holding.setdefault(located, []).append(f"{day}={e['version']}")
    return out | {(IDS, day): hashlib.md5(" ".join(held).encode()).hexdigest() for day, held in holding.items()}


def kept_counters(tables: snapshots.TableSet) -> Counters:
    out: Counters = {}
    if tables.of(TABLE):
        for r in tables.table(TABLE).collect():
            out.setdefault((r["kind"], r["day"]), (r["tag"], {}))[1][r["name"]] = r["value"]
    return out


def _dimensions_grew(tables: snapshots.TableSet, parent: snapshots.TableSet) -> bool:
    """No key of the parent's dimensions is missing."""
    def lost(name: str, key: str) -> bool:
        return not parent.table(name).join(tables.table(name), key, "left_anti").isEmpty()

    return all(parent.of(n) and not lost(n, k) for n, k in DIMENSION_KEYS.items())


def counters(tables: snapshots.TableSet, parent: snapshots.TableSet, zone: str = S.LOCAL_ZONE) -> Counters:
    """Counters of every day of ``tables``, those of unchanged days taken over from ``parent``."""
    wanted, old = tags(tables), kept_counters(parent)
    version = lambda s: [e["version"] for n in DIMENSION_KEYS for e in s.of(n).values()]
    same = version(tables) == version(parent)
    grew = same or (bool(old) and _dimensions_grew(tables, parent))
    out: Counters = {}
    for key, tag in wanted.items():
        if key in old and old[key][0] == tag:
            resolved = all(old[key][1].get(n, 0) == 0 for n in UNRESOLVED)
            if key[0] != FACT or same or (grew and resolved):
                out[key] = old[key]
    todo = {kind: {day for k, day in wanted if k == kind and (k, day) not in out} for kind in (RAW, FACT, IDS)}
    for kind, rows in (
        (RAW, lambda days: _raw_rows(tables, days)), (FACT, lambda days: _fact_rows(tables, days, zone)), (IDS, lambda days: _id_rows(tables, days)),
    ):
        for day in todo[kind]:
            out[kind, day] = (wanted[kind, day], {})
        for r in rows(todo[kind]).collect() if todo[kind] else ():
            out[kind, r["day"]][1].update({k: v for k, v in r.asDict().items() if k != "day"})
    return out


def _raw_rows(tables: snapshots.TableSet, days: Iterable[str]) -> DataFrame:
    rows = tables.table(RAW, days)
    usable = usable_filter(rows).groupBy(snapshots.day_text("scheduled_date").alias("day"))
    return usable.agg(F.count(F.lit(1)).alias("usable_raw_rows"))


def _fact_rows(tables: snapshots.TableSet, days: Iterable[str], zone: str) -> DataFrame:
    fact = tables.table(FACT, days)
    wh = Warehouse(*(occurring(tables.table(n), key, fact) for n, key in DIMENSION_KEYS.items()), fact, zone)
    joined = quality.joined_to_dims(wh).groupBy(snapshots.day_text("observed_date").alias("day"))
    return joined.agg(F.count(F.lit(1)).alias("fact_rows"), *quality.issue_counters(zone))


def _id_rows(tables: snapshots.TableSet, days: set[str]) -> DataFrame:
    rows = tables.table(FACT, tables.can_hold(FACT, days)).select(KEY, snapshots.day_text(LOCATED_BY).alias("day"))
    repeated = rows.where(F.col(KEY).isNotNull() & F.col("day").isin(*sorted(days))).groupBy("day", KEY).count().where("count > 1")
    return repeated.groupBy("day").agg(F.count(F.lit(1)).alias("duplicate_fact_ids"))


def stage_checks(tables: snapshots.TableSet, parent: snapshots.TableSet, version: str, zone: str = S.LOCAL_ZONE):
    """(the one row of the warehouse checks, ``tables`` with its counters staged as a table of the set)."""
    found = counters(tables, parent, zone)
    spark = tables.spark
    rows = [(kind, day, tag, name, value) for (kind, day), (tag, values) in sorted(found.items()) for name, value in (values or {"none": 0}).items()]
    staged = snapshots.stage(spark.createDataFrame(rows, SCHEMA).coalesce(1), tables.root, TABLE, version)
    total: dict[str, int] = {}
    for _, values in found.values():
        for name, value in values.items():
            total[name] = total.get(name, 0) + value
    missing = total.get("missing_observation_id", 0)
    duplicates = {"duplicate_fact_ids": total.get("duplicate_fact_ids", 0) + (missing > 1)}  # ids that are missing are one group
    for name, key in DIMENSION_KEYS.items():
        n = tables.table(name).groupBy(key).count().where("count > 1").count()
        duplicates[f"duplicate_{key}s"] = n
    names = ("missing_observation_id", *UNRESOLVED, "invalid_delay", "missing_observed_at", "local_date_mismatch", "local_time_period_mismatch")
    order = ("duplicate_fact_ids", "duplicate_route_keys", "duplicate_stop_keys", "duplicate_date_keys")
    row = {n: total.get(n, 0) for n in ("usable_raw_rows", "fact_rows")} | {n: duplicates[n] for n in order} | {n: total.get(n, 0) for n in names}
    checks = spark.createDataFrame([tuple(row.values())], ", ".join(f"{n} bigint" for n in row))
    return checks, tables.with_staged(staged)
