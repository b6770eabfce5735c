"""Table access and small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaystar.session import scratch_path

#: FIXED VALUE: a word is a run of characters other than these six white-space bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z and nothing else, unlike ``lower``, which also maps other alphabets."""
    return F.translate(col, UPPER, LOWER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, whatever the optimizer inlines."""
    return F.transform(F.array(value), body)[0]


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def map_batches(df: DataFrame, rows: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Map Arrow batches to batches; ``rows`` returns a list of values per output column."""
    target = _arrow_schema(df, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield to_batch(rows(batch), target)

    return df.mapInArrow(run, schema)


def to_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def _arrow_schema(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a DDL string."""
    return _arrow_schema(None, ddl)
