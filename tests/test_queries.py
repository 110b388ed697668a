"""Every registered query against its SQL, at the scale the check uses."""

from __future__ import annotations

import os

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as contract
from tests.conftest import DATA

SF_DIR = os.environ.get("QUERY_SF_DIR", str(DATA / "sf0.01"))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')"
        )
    return connection


def plain(table: pa.Table) -> tuple[dict, list]:
    table = table.select(sorted(table.column_names))
    types = {f.name: str(f.type).replace("large_", "").split("[")[0] for f in table.schema}
    return types, sorted(map(repr, zip(*[c.to_pylist() for c in table.columns])))


def test_names_agree():
    text_queries = contract.text_queries()[0]
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    assert contract.queries().keys() - contract.oracle_sql().keys() <= text_queries.keys()


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query_equals_sql(spark, oracle, name):
    types, rows = plain(contract.queries()[name](spark, SF_DIR).toArrow())
    expected_types, expected = plain(oracle.sql(contract.oracle_sql()[name]).to_arrow_table())
    assert types == expected_types
    assert rows == expected
    assert rows


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["event_type", "n", "total", "day"]
    assert result.agg({"n": "sum"}).first()[0] == 1000
