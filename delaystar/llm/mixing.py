"""Mixing sources to target weights as a time-varying curriculum.

Every source has a weight schedule: a piecewise linear weight over training time
0..1.  Its integral is the source's share of all words; shares are capped at
``max_repeat`` times the source's size and the excess goes to the others by weight
(water filling in closed form: cap sources in order of cap/weight).  Within a
source, documents lie end to end in a seeded order, repeated from the start until
the target is reached, so the words taken hit the target to the word and no
document is taken more than ``max_repeat`` times.  The integrated schedule says how
many of a source's words are due by time t; inverting it at a copy's first word
gives the copy's training position, and a range sort by position is the mix.

No source is gathered in one task: a document's offset is the sum of the sizes
before its hash bucket (one row per source and bucket, pre-aggregated) plus a
running sum within the bucket.  Only the table with a row per source meets in one
task, for the water filling.

Defined results: null text counts 0 words and is never taken; a very long text is one
document, whose words may overshoot its source's target; a null source is a
source of its own, after all others; the seeded order is by md5 of doc_id and text, so
texts that share an id, or have none, are spread over the buckets; ties go by doc_id (nulls
first) and size, and repeated rows are documents of their own; an empty table gives no
rows.  Other columns pass through, also where their names are
those of the plan's columns (the plan's then win in ``plan_mix``; ``mixed_documents``
returns the input's).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaystar.llm.tables import WORD_PATTERN, fresh_name

#: Weight schedules as (time, weight) knots, dealt to the sources by code point in turn.
#: Their integrals are the weights 5, 2 and 1: the first fades out, the last fades in.
SCHEDULES = (
    ((0.0, 7.0), (0.5, 5.0), (1.0, 3.0)),
    ((0.0, 2.0), (1.0, 2.0)),
    ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)),
)
MAX_REPEAT = 3
#: Hash buckets per source; the first ``BUCKET_DIGITS`` hex digits of the order key.
BUCKET_DIGITS = 3
PLAN_COLUMNS = ("size", "source_size", "target", "taken", "positions")


def integrals(knots: Sequence[tuple[float, float]]) -> list[float]:
    """Integral of a piecewise linear schedule from 0 to each knot."""
    out = [0.0]
    for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
        out.append(out[-1] + (t1 - t0) * (w0 + w1) / 2)
    return out


def _schedule_column(schedules, turn: Column, values) -> Column:
    """The array ``values(knots)`` of the schedule that ``turn`` names."""
    arrays = [F.array(*(F.lit(float(v)) for v in values(s))) for s in schedules]
    return F.array(*arrays)[turn]


def inverse_integral(due: Column, time: Column, weight: Column, done: Column) -> Column:
    """Time at which the integral of a schedule reaches ``due`` (knots as arrays ``time``, ``weight``, ``done``)."""
    k = F.greatest(F.size(F.filter(F.slice(done, 1, F.size(done) - 1), lambda d: d <= due)) - 1, F.lit(0))
    left = due - done[k]
    slope = (weight[k + 1] - weight[k]) / (time[k + 1] - time[k])
    root = F.sqrt(F.greatest(weight[k] * weight[k] + 2 * slope * left, F.lit(0.0)))
    step = F.when(left <= 0, F.lit(0.0)).otherwise(2 * left / (weight[k] + root))
    return F.least(time[k] + step, F.lit(1.0))


def source_targets(sizes: DataFrame, schedules=SCHEDULES, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(no_source, source_key, source_size) -> with target, turn and quota.  One row per source meets in one task."""
    everything = Window.partitionBy()
    by_name = Window.orderBy("no_source", "source_key")
    weights = F.array(*(F.lit(integrals(s)[-1]) for s in schedules))
    turned = sizes.withColumn("turn", ((F.row_number().over(by_name) - 1) % len(schedules)).cast("int"))
    weighed = (
        turned.withColumn("weight", weights[F.col("turn")])
        .withColumn("cap", F.col("source_size") * max_repeat)
        .withColumn("total", F.sum("source_size").over(everything))
    )
    # In order of cap/weight: the level of the sources from this one on, if all before it are capped.
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "no_source", "source_key")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levelled = weighed.withColumn(
        "level",
        (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward),
    ).withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    # Capped sources come first, so the first open source has the common level.
    common = F.min(F.when(~F.col("capped"), F.struct((F.col("cap") / F.col("weight")).alias("r"), "level"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(common["level"] * F.col("weight"))
    return levelled.withColumn("target", target).select(
        "no_source", "source_key", "source_size", "turn", "target", F.floor(target + 0.5).cast("bigint").alias("quota")
    )


def plan_mix(
    documents: DataFrame, schedules=SCHEDULES, max_repeat: int = MAX_REPEAT, carry: Sequence[str] | None = None
) -> DataFrame:
    """Every document with size, source_size, target, taken and positions (one per copy that is taken, ascending).

    Input columns pass through (only those in ``carry``, if given), but for any that
    have one of these five names.
    """
    kept = [c for c in (carry or documents.columns) if c.lower() not in PLAN_COLUMNS]
    own = F.struct(*(F.col(f"`{c}`") for c in kept)).alias("own")
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit(""))))
    keyed = documents.select(
        own,
        F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint").alias("size"),
        F.isnull("source").alias("no_source"),
        F.coalesce("source", F.lit("")).alias("source_key"),
        key.alias("order_key"),
        F.col("doc_id").alias("tie_id"),
        F.substring(key, 1, BUCKET_DIGITS).alias("bucket"),
    )
    buckets = keyed.groupBy("no_source", "source_key", "bucket").agg(F.sum("size").alias("bucket_size"))
    sizes = buckets.groupBy("no_source", "source_key").agg(F.sum("bucket_size").alias("source_size"))
    earlier = (
        Window.partitionBy("no_source", "source_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = buckets.select(
        "no_source", "source_key", "bucket", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("bucket_start")
    ).join(source_targets(sizes, schedules, max_repeat), ["no_source", "source_key"])
    before = (
        Window.partitionBy("no_source", "source_key", "bucket")
        .orderBy("order_key", "tie_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = (
        keyed.withColumn("running", F.coalesce(F.sum("size").over(before), F.lit(0)))
        .join(offsets, ["no_source", "source_key", "bucket"])
        .withColumn("start", F.col("bucket_start") + F.col("running"))
    )
    copies = F.transform(F.sequence(F.lit(0), F.lit(max_repeat - 1)), lambda k: F.col("start") + k * F.col("source_size"))
    taken = F.aggregate(
        copies,
        F.lit(0).cast("bigint"),
        lambda acc, at: acc + F.greatest(F.lit(0).cast("bigint"), F.least(F.col("size"), F.col("quota") - at)),
    )
    firsts = F.filter(copies, lambda at: (at < F.col("quota")) & (F.col("size") > 0))
    done = _schedule_column(schedules, F.col("turn"), integrals)
    time = _schedule_column(schedules, F.col("turn"), lambda s: [t for t, _ in s])
    weight = _schedule_column(schedules, F.col("turn"), lambda s: [w for _, w in s])
    due = lambda at: at / F.col("quota") * F.element_at(done, -1)
    return placed.select(
        *(F.col(f"own.`{c}`") for c in kept),
        "size",
        F.col("source_size"),
        F.col("target"),
        taken.alias("taken"),
        F.transform(firsts, lambda at: inverse_integral(due(at), time, weight, done)).alias("positions"),
    )


def mixed_documents(documents: DataFrame) -> DataFrame:
    """``training_order`` of the plan of ``documents``, with all their columns, also those named like the plan's.

    Such columns travel through the plan under fresh names.
    """
    carried, renamed = documents, {}
    for name in documents.columns:
        if name.lower() in PLAN_COLUMNS:
            renamed[name] = fresh_name(carried, f"_{name}")
            carried = carried.withColumnRenamed(name, renamed[name])
    mixed = training_order(plan_mix(carried))
    return mixed.select(*(F.col(f"`{renamed.get(c, c)}`").alias(c) for c in documents.columns))


def training_order(planned: DataFrame) -> DataFrame:
    """One row per copy that the mix takes, range-sorted by training position; whole texts, the plan's columns dropped."""
    kept = [c for c in planned.columns if c not in PLAN_COLUMNS]
    at = "position"
    while at in kept:
        at = f"_{at}"
    copies = planned.select(*(F.col(f"`{c}`") for c in kept), F.explode("positions").alias(at))
    return copies.repartitionByRange(F.col(at), F.col("doc_id")).sortWithinPartitions(at, "doc_id").drop(at)


def mix_digest(documents: DataFrame) -> DataFrame:
    """The plan of every document, in training order of its first copy (documents that are not taken last)."""
    planned = plan_mix(documents, carry=["doc_id"])
    first = F.element_at(F.col("positions"), 1)
    return (
        planned.withColumn("first_position", F.when(F.size("positions") > 0, first))
        .select("doc_id", "size", "source_size", "target", "taken", "first_position")
        .repartitionByRange(F.col("first_position").asc_nulls_last(), F.col("doc_id"))
        .sortWithinPartitions(F.col("first_position").asc_nulls_last(), "doc_id")
    )


def oracle() -> str:
    """DuckDB twin: plain windows over whole sources, no buckets."""
    weights = ", ".join(str(integrals(s)[-1]) for s in SCHEDULES)

    def arrays(values) -> str:
        return "[" + ", ".join("[" + ", ".join(repr(float(v)) for v in values(s)) + "]" for s in SCHEDULES) + "]"

    return rf"""
WITH sized AS (
  SELECT doc_id, source IS NULL AS no_source, coalesce(source, '') AS source_key,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || coalesce(text, '')) AS order_key,
         CAST(coalesce(len(regexp_extract_all(text, '{WORD_PATTERN}')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT no_source, source_key, CAST(sum(size) AS BIGINT) AS source_size,
         CAST((row_number() OVER (ORDER BY no_source, source_key) - 1) % {len(SCHEDULES)} AS INTEGER) + 1 AS turn
  FROM sized GROUP BY no_source, source_key),
weighed AS (
  SELECT *, CAST([{weights}][turn] AS DOUBLE) AS weight, source_size * {MAX_REPEAT} AS cap,
         sum(source_size) OVER () AS total FROM sources),
levelled AS (
  SELECT *, CAST(total - coalesce(sum(cap) OVER (lv ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
            / sum(weight) OVER (lv ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW lv AS (ORDER BY cap / weight, no_source, source_key)),
marked AS (SELECT *, cap <= level * weight AS capped FROM levelled),
targets AS (
  SELECT *, CASE WHEN capped THEN CAST(cap AS DOUBLE)
            ELSE (SELECT arg_min(level, cap / weight) FROM marked WHERE NOT capped) * weight END AS target
  FROM marked),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.turn, CAST(floor(t.target + 0.5) AS BIGINT) AS quota,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.no_source, d.source_key ORDER BY d.order_key, d.doc_id NULLS FIRST, d.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized d JOIN targets t ON d.no_source = t.no_source AND d.source_key = t.source_key),
due AS (
  SELECT *, {arrays(lambda s: [t for t, _ in s])}[turn] AS tm, {arrays(lambda s: [w for _, w in s])}[turn] AS wt,
         {arrays(integrals)}[turn] AS done, start / CAST(quota AS DOUBLE) * {arrays(integrals)}[turn][-1] AS y
  FROM placed),
segment AS (SELECT *, greatest(len(list_filter(done[1:-2], lambda d: d <= y)), 1) AS k FROM due),
solved AS (
  SELECT *, y - done[k] AS lft, (wt[k + 1] - wt[k]) / (tm[k + 1] - tm[k]) AS slope FROM segment)
SELECT doc_id, size, source_size, target,
       CAST({" + ".join(f"greatest(0, least(size, quota - (start + {k} * source_size)))" for k in range(MAX_REPEAT))} AS BIGINT) AS taken,
       CASE WHEN size > 0 AND start < quota THEN
         least(tm[k] + CASE WHEN lft <= 0 THEN 0.0 ELSE 2 * lft / (wt[k] + sqrt(greatest(wt[k] * wt[k] + 2 * slope * lft, 0.0))) END, 1.0)
       END AS first_position
FROM solved"""
