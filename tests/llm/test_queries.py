"""The queries of this subpackage as registered."""

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.support import SMALL, compare, duck
from textpulse.llm.oracles import ORACLES
from textpulse.llm.queries import QUERIES


def test_registered():
    names = set(contract.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_its_oracle(spark, name):
    actual = contract.queries()[name](spark, SMALL).toPandas()
    expected = duck(SMALL).execute(ORACLES[name]).fetchdf()
    assert compare(actual, expected) is None


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = {r.doc_id for r in docs.select("doc_id").collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SMALL)
        assert after.columns == docs.columns
        docs = corpus_pipeline.written(after, "test")
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert ids <= before
        before = ids
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert len(last) == docs.count() > 0
    assert all(r.restored for r in last)
    assert contract.queries()["pipeline"](spark, SMALL).count() == len(last)


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0
