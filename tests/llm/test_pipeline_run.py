import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline

BASE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="test tables absent")


def test_stages_keep_the_columns_and_shrink(spark):
    docs = spark.read.parquet(f"{BASE}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, BASE)
        assert docs.columns == columns, name
    assert 0 < docs.count() <= n
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(corpus_pipeline.STAGES[-1][1](spark, docs, BASE).columns)


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and sum(x.startswith("op") and x[2].isdigit() for x in names) == 13
