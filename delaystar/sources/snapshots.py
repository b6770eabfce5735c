"""Sets of tables that become current together: write versions, audit them, publish one commit.

Layout under a root on shared storage::

    <table>/version=<v>/                      a version of an unpartitioned table
    <table>/version=<v>/<column>=<value>/     the partitions that version <v> wrote
    _manifests/<number>-<version>/            one row per (table, partition) of a published set
    _COMMITS/                                 one line per commit: number, manifest folder

A set is what one manifest lists.  A new set takes the entries of its parent, replaces those
that were staged and leaves out those that were emptied, so a cycle writes only the
partitions that it touches and nothing that a reader may be reading.  Staged folders are
unknown to readers until the commit line, one small file, names their manifest; a writer that
dies before that leaves the former set in service.  Of two commits with one number the
first line in order counts and the other writer is told.

A manifest has one row per partition (days here), which is what the driver holds.  Its rows
also carry the row count, an order-free digest of the rows, and ``located``: the days of a
second time in the partition.  Where an id fixes that time, they say which partitions
can hold an id, and a merge opens no others.  ``newest`` is the latest time in the
partition, so that a page of latest rows opens the partitions that can be on it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaystar.sources import sinks

COMMITS, MANIFESTS = "_COMMITS", "_manifests"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
ENTRY_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("by", T.StringType()),
    T.StructField("partition", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("digest", T.StringType()),
    T.StructField("located", T.ArrayType(T.StringType())),
    T.StructField("newest", T.TimestampNTZType()),
    T.StructField("table_schema", T.StringType()),
])


class PublishConflict(RuntimeError):
    """Another writer published a set on the same parent first."""


def day_text(column: str) -> Column:
    """The folder value of the day of a date or time."""
    return F.coalesce(F.to_date(column).cast("string"), F.lit(NULL_PARTITION))


def days_of(df: DataFrame, column: str) -> set[str]:
    """Distinct days of ``column`` as folder values."""
    return {r[0] for r in df.select(day_text(column)).distinct().collect()}


@dataclass(frozen=True)
class TableSet:
    """The tables that one manifest lists; ``number`` is None for a set that is only proposed."""

    spark: SparkSession
    root: str
    number: int | None
    entries: tuple[Row, ...]

    def of(self, table: str) -> dict[str | None, Row]:
        """Entries of a table by partition value."""
        return {e["partition"]: e for e in self.entries if e["table_name"] == table}

    def table(self, name: str, partitions: Iterable[str] | None = None) -> DataFrame:
        """A table of the set, or some of its partitions; no other partition's files are listed or read."""
        own = self.of(name)
        if not own:
            raise KeyError(f"no table {name} in this set of {self.root}")
        chosen = list(own.values()) if partitions is None else [own[p] for p in sorted(set(partitions)) if p in own]
        schema = T.StructType.fromJson(json.loads(next(iter(own.values()))["table_schema"]))
        base = f"{self.root}/{name}"
        paths = [f"{base}/version={e['version']}" + (f"/{e['by']}={e['partition']}" if e["by"] else "") for e in chosen]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)

    def can_hold(self, table: str, located: Iterable[str]) -> set[str]:
        """Partitions of ``table`` with a row whose second time is on one of the days ``located``."""
        wanted = set(located)
        return {p for p, e in self.of(table).items() if wanted.intersection(e["located"] or ())}

    def with_staged(self, staged: Iterable[Row], touched: dict[str, set[str]] | None = None) -> TableSet:
        """The proposed set: staged entries instead of those of the same table and partition.

        ``touched`` names the partitions that a cycle rewrote; those without a staged entry
        kept no row and leave the set.  A staged entry with the row count and digest of
        the one in place changes nothing, so that one stays.
        """
        staged, kept = list(staged), []
        whole = {e["table_name"] for e in staged if e["by"] is None}
        replaced = {(e["table_name"], e["partition"]) for e in staged}
        for e in self.entries:
            gone = e["partition"] in (touched or {}).get(e["table_name"], ())
            if e["table_name"] not in whole and (e["table_name"], e["partition"]) not in replaced and not gone:
                kept.append(e)
        old = {(e["table_name"], e["partition"]): e for e in self.entries}
        for e in staged:
            before = old.get((e["table_name"], e["partition"]))
            same = before is not None and all(before[k] == e[k] for k in ("by", "row_count", "digest", "table_schema"))
            kept.append(before if same else e)
        return TableSet(self.spark, self.root, None, tuple(kept))

    def changed_since(self, parent: TableSet) -> set[tuple[str, str | None]]:
        """(table, partition) pairs that this set holds in another version than ``parent``, or not at all."""
        mine, theirs = ({(e["table_name"], e["partition"]): e["version"] for e in s.entries} for s in (self, parent))
        return {k for k in mine.keys() | theirs.keys() if mine.get(k) != theirs.get(k)}


def newest_rows(tables: TableSet, table: str, time: str, limit: int, chosen=lambda rows: rows, ties: tuple[str, ...] = ()) -> DataFrame:
    """The ``limit`` latest rows of ``chosen(table)`` by ``time`` (missing times last, then ``ties`` ascending).

    Partitions are taken from the newest on, as many as have ``limit`` rows and twice as many
    each time that ``chosen`` (a filter or a join) leaves too few.  Then those whose newest
    time reaches the last row found are added, since only they can change the page, and no
    other partition is opened.
    """
    order = [F.col(time).desc_nulls_last(), *[F.col(c).asc() for c in ties]]
    own = sorted(tables.of(table).values(), key=lambda e: (e["newest"] is not None, e["newest"]) if e["newest"] else (False, 0), reverse=True)
    taken = held = 0
    while taken < len(own) and held < limit:
        held += own[taken]["row_count"]
        taken += 1

    def page(n: int) -> DataFrame:
        return chosen(tables.table(table, [e["partition"] for e in own[:n]])).orderBy(*order).limit(limit)

    while taken < len(own):
        last = page(taken).agg(F.count(F.lit(1)).alias("n"), F.min(time).alias("last"), F.count_if(F.col(time).isNull()).alias("missing")).first()
        if last["n"] < limit or last["missing"]:
            taken = min(len(own), 2 * taken)
            continue
        reach = sum(1 for e in own if e["newest"] is not None and e["newest"] >= last["last"])
        if reach <= taken:
            break
        taken = reach
    return page(taken)


def empty_set(spark: SparkSession, root: str) -> TableSet:
    return TableSet(spark, root.rstrip("/"), 0, ())


def stage(df: DataFrame, root: str, table: str, version: str, *, by: str | None = None,
          order: tuple[str, ...] = (), located_by: str | None = None, newest_of: str | None = None) -> list[Row]:
    """Write ``df`` as ``version`` of a table, unseen by readers; returns its entries, one per partition written.

    Partitioned tables are range-partitioned by ``by`` (a date) and ``order``, so that a large
    day is several files and files are clustered.  Counts, digests and ``located`` come
    from one aggregate over what was written.
    """
    path = f"{root.rstrip('/')}/{table}/version={version}"
    if by:
        keys = (by, *order)
        writer = df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.partitionBy(by)
    else:
        writer = df.write
    writer.mode("errorifexists").option("compression", "zstd").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    digest = F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")).cast("string")
    located = F.array_sort(F.collect_set(day_text(located_by))) if located_by else F.any_value(F.lit(None).cast("array<string>"))
    newest = F.max(newest_of) if newest_of else F.any_value(F.lit(None).cast("timestamp_ntz"))
    measures = (F.count(F.lit(1)).alias("row_count"), F.coalesce(digest, F.lit("0")).alias("digest"), located.alias("located"),
                newest.alias("newest"))
    if by:
        stats = written.groupBy(day_text(by).alias("partition")).agg(*measures)
    else:
        stats = written.agg(*measures).withColumn("partition", F.lit(None).cast("string"))
    named = {"table_name": F.lit(table), "by": F.lit(by).cast("string"), "version": F.lit(version),
             "table_schema": F.lit(df.schema.json())}
    return stats.withColumns(named).select(*ENTRY_SCHEMA.names).collect()


def _commit_lines(spark: SparkSession, root: str) -> list[str]:
    try:
        return [r[0] for r in spark.read.text(f"{root}/{COMMITS}").collect()]
    except AnalysisException as e:
        if not sinks.path_missing(e):
            raise
        return []


def published(spark: SparkSession, root: str, number: int | None = None) -> TableSet:
    """The newest published set, or that of a commit number; the empty set where nothing was published."""
    root = root.rstrip("/")
    lines = _commit_lines(spark, root)
    wanted = max((int(x.split(" ", 1)[0]) for x in lines), default=0) if number is None else number
    own = [x for x in lines if int(x.split(" ", 1)[0]) == wanted]
    if not own:
        if number:
            raise FileNotFoundError(f"no commit {number} of {root}")
        return empty_set(spark, root)
    manifest = min(own).split(" ", 1)[1]
    rows = spark.read.schema(ENTRY_SCHEMA).parquet(f"{root}/{MANIFESTS}/{manifest}").collect()
    return TableSet(spark, root, wanted, tuple(rows))


def publish(proposed: TableSet, parent: TableSet, version: str) -> TableSet:
    """Make a proposed set current in one step; PublishConflict if the parent is not the newest set any more."""
    spark, root, number = proposed.spark, proposed.root, parent.number + 1
    if published(spark, root).number != parent.number:
        raise PublishConflict(f"set {parent.number} of {root} is not the newest one")
    manifest = f"{number:020d}-{version}"
    spark.createDataFrame([tuple(e) for e in proposed.entries], ENTRY_SCHEMA).coalesce(1).write.parquet(f"{root}/{MANIFESTS}/{manifest}")
    line = f"{number:020d} {manifest}"
    spark.createDataFrame([(line,)], "line string").coalesce(1).write.mode("append").text(f"{root}/{COMMITS}")
    if min(x for x in _commit_lines(spark, root) if x.startswith(f"{number:020d} ")) != line:
        raise PublishConflict(f"another writer published set {number} of {root}")
    return TableSet(spark, root, number, proposed.entries)
