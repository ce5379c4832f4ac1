"""Every catalogue query against its SQL in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as spark_entry
from check import TABLES, compare
from wattloom.plans.catalogue import QUERIES
from wattloom.plans.oracle import oracle_queries

SQL = oracle_queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, sf_dir, name):
    verdict = compare(spark, con, sf_dir, name, SQL[name])
    assert verdict.startswith("ok") and "types" not in verdict, verdict


def test_every_sql_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
    assert set(SQL) <= set(QUERIES) <= set(spark_entry.queries())


def test_only_models_have_no_sql():
    assert set(QUERIES) - set(SQL) == {
        "ml_predictions",
        "ml_metrics",
        "ml_importance",
        "ml_stream_score",
    }


def test_entry_returns_rows(spark):
    assert spark_entry.entry(spark).count() > 0
