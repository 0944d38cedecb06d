"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
import check  # noqa: E402
from chunkatlas.plans.oracles import ORACLES  # noqa: E402
from chunkatlas.plans.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    found = check.compare(spark, con, name, SF)
    assert not found or found.startswith("rows only")


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLES) == {"file_manifest", "sync_apply"}


def test_optional_queries():
    optional = set(entry.queries()) - set(QUERIES)
    assert all(name == "pipeline" or name.startswith("op") for name in optional)
