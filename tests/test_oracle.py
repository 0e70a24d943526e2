"""Every registered query equals its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import normal
from staywarehouse.checks import oracle
from staywarehouse.checks.queries import registered

FOLDER = "/root/testdata/sf0.001"
SQL = oracle.statements()


@pytest.fixture(scope="module")
def db():
    made = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        made.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return made


def test_names():
    assert set(SQL) == set(registered())
    assert set(SQL) <= set(entry.oracle_sql()) and set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = db.execute(SQL[name])
    wanted = normal(cursor.fetchall(), [c[0] for c in cursor.description])
    assert normal([tuple(r) for r in df.collect()], df.columns) == wanted


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["full_date", "daily_revenue", "revenue_ytd"]
    assert rows.count() > 0
