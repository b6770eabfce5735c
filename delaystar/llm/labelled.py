"""Folds and bounded training samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaystar.llm.tables import arrow_schema, to_batch

#: Most classes that a sample covers, and how many times the asked number of ids are drawn before the exact choice.
MAX_CLASSES, DRAWN = 200, 2


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of doc_id as text, modulo ``folds``; a null id is fold 0."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % folds, F.lit(0))


def class_sample(rows: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, ``label``) of each class's ``per_class`` ids with the smallest hashes, one row per id.

    Every class gets its own share, whatever the others and repeated ids hold, and the
    sample does not depend on how rows are partitioned.  A hash threshold per class,
    from its approximate number of distinct ids, cuts the rows before anything is
    shuffled.  Of more than ``MAX_CLASSES`` classes the largest are learned, so the
    sample has at most ``per_class * MAX_CLASSES`` rows.  An id that is drawn for several
    classes counts for the smallest.
    """
    rows = rows.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", label)
    sizes = rows.groupBy(label).agg(F.approx_count_distinct("doc_id").alias("n")).orderBy(F.desc("n"), label).limit(MAX_CLASSES)
    ticket, scale = F.xxhash64("doc_id", F.lit(17)), 1 << 62
    chosen = F.lit(False)
    for value, n in sizes.collect():
        chosen = chosen | ((F.col(label) == F.lit(value)) & (F.pmod(ticket, F.lit(scale)) < int(min(1.0, DRAWN * per_class / n) * scale)))
    one = rows.where(chosen).groupBy("doc_id").agg(F.min(label).alias(label)).withColumn("ticket", F.pmod(ticket, F.lit(scale)))
    place = F.row_number().over(Window.partitionBy(label).orderBy("ticket", "doc_id"))
    return one.withColumn("place", place).where(F.col("place") <= per_class).select("doc_id", label)


def collected(texts: DataFrame, kind: str, prepare: Callable[[str], bytes]) -> list[tuple[bytes, object]]:
    """(prepare(text), label) by doc_id of sampled rows (doc_id, text, label of type ``kind``), one per doc_id.

    Texts are prepared in tasks and only that is collected.  Of rows that share a
    doc_id the text with the smallest hash counts: first in each task, then among tasks.
    """
    ddl = f"doc_id bigint, label {kind}, place bigint, value binary"
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[object, int, bytes]] = {}
        for batch in batches:
            for i, text, y in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "label")), strict=True):
                place = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1
                if i not in best or place < best[i][1]:
                    best[i] = (y, place, prepare(text))
        if best:
            ys, places, values = zip(*best.values(), strict=True)
            yield to_batch({"doc_id": list(best), "label": ys, "place": places, "value": values}, schema)

    found = texts.select("doc_id", "text", "label").mapInArrow(run, ddl)
    rows = found.groupBy("doc_id").agg(F.min_by("value", "place").alias("value"), F.min("label").alias("label")).collect()
    return [(bytes(r["value"]), r["label"]) for r in sorted(rows, key=lambda r: r["doc_id"])]


def labelled_samples(
    documents: DataFrame, labels: DataFrame, label: str, per_class: int, folds: int, held_out: int, prepare: Callable[[str], bytes]
) -> list[tuple[bytes, float]]:
    """(prepare(text), label) of a bounded sample of labelled documents outside the held-out fold, by doc_id.

    The sample is drawn from the narrow label table; its bounded list of ids is the
    broadcast side of one pass over the texts.
    """
    trainable = labels.select("doc_id", F.col(label).cast("double").alias("label")).where(fold(F.col("doc_id"), folds) != held_out)
    sample = class_sample(trainable, "label", per_class)
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(sample), "doc_id")
    return collected(texts, "double", prepare)
