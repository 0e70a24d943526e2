"""Registered queries equal their SQL; the pipeline does what its stages say."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check import normal
from staywarehouse.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.statements()))
def test_equal(spark, name):
    db = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = entry.queries()[name](spark, FOLDER)
    cursor = db.execute(queries.statements()[name])
    wanted = normal(cursor.fetchall(), [c[0] for c in cursor.description])
    assert normal([tuple(r) for r in df.collect()], df.columns) == wanted


def test_names():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names}
    assert "pipeline" in names


def test_pipeline(spark, table, docs, edges, nothing):
    columns = table("documents").columns
    before = table("documents")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, FOLDER)
        assert after.columns[:len(columns)] == columns
        if i < 4:
            assert after.columns == columns
        path = f"{spark.conf.get('spark.checkpoint.dir')}/pipeline-{os.getpid()}-{i}"
        after.write.parquet(path)
        after = spark.read.parquet(path)
        assert 0 < after.count() <= before.count()
        before = after
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(r.doc_id for r in whole.collect()) == sorted(r.doc_id for r in before.collect())
    texts = [r.text for r in whole.collect()]
    assert len(set(texts)) == len(texts)


@pytest.mark.parametrize("which", ["edges", "nothing"])
def test_stages_take_odd_rows(spark, which, request):
    docs = request.getfixturevalue(which)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert out.columns[:len(docs.columns)] == docs.columns
        out.collect()
