"""The registered queries and the pipeline."""

import pytest

import corpus_pipeline
from stylograph.llm import queries as Q
from stylograph.llm.common import documents
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_sql(spark, name):
    ok, message = compare(spark, connect(SF), name, Q.queries()[name], Q.SQL[name], SF)
    assert ok, message


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.SQL)))
def test_query_runs_over_all_documents(spark, name):
    rows = Q.queries()[name](spark, SF)
    ids = {r.doc_id for r in rows.select("doc_id").collect()}
    assert ids == {r.doc_id for r in documents(spark, SF).select("doc_id").collect()}


def test_pipeline(spark):
    docs = before = documents(spark, SF)
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), name.replace(" ", "-"))
        assert docs.columns == before.columns
        counts.append(docs.count())
    assert before.count() > counts[0] >= counts[1] >= counts[2] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_pipeline_on_an_empty_table(spark):
    docs = documents(spark, SF).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), name.replace(" ", "-"))
        assert docs.count() == 0
