"""The registered corpus queries and the pipeline on the smallest tables."""

import pytest
from conftest import SF_DIR
from oracle_check import connect, differences
from pyspark.sql import functions as F

import corpus_pipeline
from spanledger.llm.queries import ORACLES, QUERIES, table
from spanledger.sources.scratch import durable


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) == []


def test_every_document_has_a_row(spark):
    n = table(spark, SF_DIR, "documents").count()
    for name in ("op5_language", "op6_toxicity", "op7_simhash", "op8_quality", "op9_sharding"):
        assert QUERIES[name](spark, SF_DIR).count() == n, name
    assert QUERIES["op2_url_filter"](spark, SF_DIR).count() == table(spark, SF_DIR, "pages").count()


def test_stages_agree_with_the_operators(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, kept = docs.columns, docs
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before, kept = kept, durable(stage(spark, kept, SF_DIR), "stage")
        assert kept.columns == columns
        assert kept.join(before, "doc_id", "left_anti").count() == 0
        if number == 1:
            assert kept.count() == before.select(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " ")).distinct().count()
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == {r[0] for r in kept.select("doc_id").collect()}
