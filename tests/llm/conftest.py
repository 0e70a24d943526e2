import duckdb
import pytest

from staywarehouse.llm.scratch import reachable

from . import brute

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    return reachable(spark)


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")


@pytest.fixture(scope="session")
def rows():
    return lambda sql: duckdb.connect().execute(sql.replace("{f}", FOLDER)).fetchall()


@pytest.fixture(scope="session")
def docs(rows):
    return rows("SELECT doc_id, text FROM '{f}/documents.parquet' ORDER BY doc_id")


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(brute.EDGES, brute.SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], brute.SCHEMA)
