"""Several groupings of one input from a single pass.

The input is first aggregated by all grouping columns together; sums, counts and
maxima merge, so every part can be cut from that aggregate.  ``GROUPING SETS`` over it (far
fewer rows than the input, where values repeat) gives all parts in one exchange, and
the result, a few rows per group, is written once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaystar.session import dimension


class Parts:
    """The groupings of one pass; ``part(columns)`` has those columns and the merged measures."""

    def __init__(self, rows: DataFrame, columns: Sequence[str]) -> None:
        self.rows, self.columns = rows, tuple(columns)

    @staticmethod
    def set_id(columns: Sequence[str], of: Sequence[str]) -> int:
        """``grouping_id`` of a set: a bit for each grouping column that it lacks, the last one lowest."""
        return sum(1 << (len(of) - 1 - i) for i, c in enumerate(of) if c not in columns)

    def part(self, *columns: str) -> DataFrame:
        gone = [c for c in self.columns if c not in columns]
        return self.rows.where(F.col("_set") == self.set_id(columns, self.columns)).drop("_set", *gone)


def one_pass(df: DataFrame, groupings: Sequence[Sequence[str]], sums: Sequence[str], maxima: Sequence[str] = ()) -> Parts:
    """Aggregate ``df`` by each of ``groupings`` with one scan; measures keep their names."""
    columns = tuple(dict.fromkeys(c for g in groupings for c in g))
    merge = lambda: [*(F.sum(c).alias(c) for c in sums), *(F.max(c).alias(c) for c in maxima)]
    base = df.groupBy(*columns).agg(*merge())
    distinct = list(dict.fromkeys(tuple(c for c in columns if c in g) for g in groupings))
    sets = base.groupingSets([[F.col(c) for c in g] for g in distinct], *[F.col(c) for c in columns])
    return Parts(dimension(sets.agg(*merge(), F.grouping_id().alias("_set"))), columns)


def stacked(parts: Mapping[str, DataFrame]) -> DataFrame:
    """All parts as one table: ``part`` names them, columns that a part lacks are null."""
    out = None
    for name, df in parts.items():
        named = df.select(F.lit(name).alias("part"), "*")
        out = named if out is None else out.unionByName(named, allowMissingColumns=True)
    return out
