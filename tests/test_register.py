"""Every registered query against its checking SQL on the same tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entries
from starloom.plans.register import CHECKS, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entries.queries())


def test_entry(spark):
    assert entries.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    ours = in_order(tuple(r[c] for c in columns) for r in df.collect())
    cursor = database.execute(CHECKS[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert ours == in_order(tuple(r[i] for i in at) for r in cursor.fetchall())
