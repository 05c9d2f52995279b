"""The driver contract: every query agrees with its oracle on the smallest tables."""

from __future__ import annotations

import __spark_entry__ as contract
import duckdb
import pytest

from checks.compare import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_an_oracle():
    """But for those of the training-data subpackage that SQL can't express; its own tests have them."""
    from checks.queries import QUERIES

    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query(spark, db, name):
    df = contract.queries()[name](spark, SF)
    cursor = db.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())
