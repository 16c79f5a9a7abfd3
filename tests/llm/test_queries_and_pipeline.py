"""Registered queries against their SQL, and the stages of the pipeline."""

from pathlib import Path

import corpus_pipeline
import pytest

import __spark_entry__ as entry
from check_queries import compare
from vertexloom.llm import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, name):
    assert compare(spark, FOLDER, name, []) == ""


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.queries()}
    assert {*queries.queries(), "pipeline"} <= set(entry.queries())


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns and 0 < docs.count() <= before
        before = docs.count()
    mixed = corpus_pipeline.run(spark, FOLDER)
    assert sorted(r["mix_position"] for r in mixed.collect()) == list(range(before))
    assert sorted(r["doc_id"] for r in mixed.collect()) == sorted(r["doc_id"] for r in docs.collect())


def test_stages_take_awkward_rows(spark, documents, awkward):
    docs = documents(awkward, extra=False)
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, FOLDER).select(*documents(awkward, extra=False).columns)
    # the repeated row stays once, everything else is kept
    assert docs.count() == len(awkward) - 1
