"""Every registered query against its DuckDB oracle on the smallest data set."""

import glob
import os

import duckdb
import pytest

from hrqueries import QUERIES
from oracles import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, oracle, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    cursor = oracle.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = [tuple(row[names.index(c)] for c in columns) for row in cursor.fetchall()]
    assert ordered(map(tuple, frame.select(*columns).collect())) == ordered(expected)
