"""Every registered query against its SQL twin on the smallest test tables."""

import decimal
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from headwater.plans.oracle import ORACLE
from headwater.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def twin():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    return int(value) if isinstance(value, decimal.Decimal) else value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(picked, key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_a_twin():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_twin(spark, twin, name):
    found = queries()[name](spark, SF_DIR)
    result = twin.execute(oracle_sql()[name])
    expected = table([column[0] for column in result.description], result.fetchall())
    assert expected[1], "the twin finds rows"
    assert table(found.columns, [tuple(row) for row in found.collect()]) == expected


def test_entry(spark):
    assert entry(spark).count() == 150
