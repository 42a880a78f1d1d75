"""The pipeline's stages keep what they should, with the columns of documents."""

import pytest

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.oracle import compare, connect
from winnow.llm import queries


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        after = stage(spark, before, SF_SMALL).cache()
        assert after.columns == columns and after.count() > 0, name
        assert after.select("doc_id").subtract(before.select("doc_id")).count() == 0
        before = after
    last = corpus_pipeline.STAGES[4][1](spark, before, SF_SMALL)
    assert last.count() == before.count()


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_matches_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF_SMALL), connect(SF_SMALL), queries.SQL[name]) is None
