"""Every registered query against its SQL run by DuckDB on the smallest test tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from seasonstats.plans import registry
from tests.conftest import SF, duck_rows, rows_of

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    expected, names = duck_rows(con, entry.oracle_sql()[name])
    assert sorted(df.columns) == names
    assert rows_of(df) == expected
    assert expected


def test_queries_without_sql_are_model_queries():
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(registry.QUERIES) - set(registry.SQL) == {"feature_importances", "model_auc", "model_scores"}


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 174
    assert df.count() > 0
