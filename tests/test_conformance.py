"""Every registered query against its SQL, over the whole tables of one scale."""

import os

import duckdb
import pytest

from conformance import ORACLES, QUERIES

SF_DIR = os.environ.get("CONFORMANCE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{SF_DIR}/{file}')")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_agrees_with_sql(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = oracle.execute(ORACLES[name])
    columns = sorted(column[0] for column in expected.description)
    assert sorted(df.columns) == columns
    order = [column[0] for column in expected.description]
    want = sorted((tuple(row[order.index(c)] for c in columns) for row in expected.fetchall()), key=repr)
    got = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)
    assert len(got) == len(want)
    assert len(got) > 0
    assert got == want
