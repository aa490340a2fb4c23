"""Every registered query against its DuckDB oracle."""

import os

import duckdb
import pytest

import __spark_entry__ as contract

SQL_TYPES = {"BIGINT": "bigint", "VARCHAR": "string", "BOOLEAN": "boolean", "INTEGER": "int", "DOUBLE": "double"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for file in os.listdir(sf):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{sf}/{file}'")
    return con


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_oracle(spark, sf, duck, name):
    got = contract.queries()[name](spark, sf)
    want = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    types = dict(got.dtypes)
    for column, _type in [(c[0], str(c[1])) for c in want.description]:
        assert SQL_TYPES[_type] == types[column], column
    expected = sorted(map(repr, want.fetchall()))
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == expected
    assert expected


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_page_sections(spark, sf):
    rows = contract.queries()["page_sections"](spark, sf)
    pages = spark.read.parquet(f"{sf}/pages.parquet").count()
    assert rows.where("section_id = 0").count() == pages
    assert rows.where("tag = 'PARAGRAPH' and length(text) > 0").count() > pages
