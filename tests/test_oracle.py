"""Every registered query against its SQL, value by value, over whole tables."""

import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from loomfeed.plans.catalog import QUERIES
from loomfeed.plans.oracle import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in sorted(os.listdir(SF_DIR)):
        con.execute(f"create view {name.removesuffix('.parquet')} as from '{SF_DIR}/{name}'")
    return con


DUCK_TYPES = {"boolean": "BOOLEAN", "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR"}


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def test_every_query_of_the_catalog_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = queries()[name](spark, SF_DIR)
    want = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    types = {c[0]: str(c[1]) for c in want.description}
    assert {name: DUCK_TYPES[t] for name, t in got.dtypes} == types
    expected = rows_of(columns, want.fetchall())
    actual = rows_of(got.columns, [tuple(r) for r in got.collect()])
    assert sum(expected.values()) > 0
    assert actual == expected


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["ex_id", "copy_id", "input_ids", "attention_mask", "labels"]
    assert df.count() == 34 * 3
