"""Every registered query against its SQL, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from workload.registry import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(
            f"create view {table} as select * from '{FOLDER}/{table}.parquet'"
        )
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def ordered(rows, names):
    picked = [tuple(plain(row[names.index(n)]) for n in sorted(names)) for row in rows]
    return sorted(picked, key=repr)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_its_sql(spark, duck, key):
    df = QUERIES[key](spark, FOLDER)
    found = duck.execute(ORACLE[key])
    names = [column[0] for column in found.description]
    assert sorted(df.columns) == sorted(names)
    assert ordered(df.collect(), df.columns) == ordered(found.fetchall(), names)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
