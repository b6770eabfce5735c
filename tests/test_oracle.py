"""Every registered query of the warehouse against its DuckDB twin on the smallest test data."""

import duckdb
import pytest

import __spark_entry__ as E
from delaystar.plans import registry
from tools.compare_oracle import TABLES, table_hash

from .conftest import SMALL_SF

NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL_SF}/{t}.parquet')")
    return con


def test_every_query_has_a_twin():
    assert not set(registry.QUERIES) - set(E.oracle_sql())
    assert not set(E.oracle_sql()) - set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, duck, name):
    sdf = E.queries()[name](spark, SMALL_SF)
    srows = [tuple(r) for r in sdf.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    assert table_hash(sdf.columns, srows) == table_hash(rel.columns, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 1
    assert df.columns == ["avg_delay_minutes", "max_delay_minutes", "observation_count", "delayed_ratio",
                          "significant_or_severe_count"]
