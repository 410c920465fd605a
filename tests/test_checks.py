import pytest
from pyspark.sql import functions as F

from spanledger.plans.checks import ModelChecks, check_and_store, run_checks
from spanledger.sources import writers
from spanledger.sources.scratch import fresh_path

RUN = "2024-01-02 00:00:00"


@pytest.fixture(scope="module")
def models(spark):
    a = spark.sql("select * from values (1, 'x', timestamp_ntz'2024-01-01 12:00:00'), (1, null, null) t(id, name, at)")
    return {"a": a, "b": a.limit(1)}


DECLARED = {
    "a": ModelChecks(not_null=("id", "name"), unique=(("id",),), expressions={"small": "id < 9"}, recency={"at": (1, "day")},
                     equal_to=("b",), warn=("name",)),
    "b": ModelChecks(not_null=("id",)),
}


def found(df):
    return {(r.model, r.check_name, r.subject): (r.failures, r.status) for r in df.collect()}


def test_every_declared_check_has_a_verdict(models):
    assert found(run_checks(models, RUN, DECLARED)) == {
        ("a", "not_null", "id"): (0, "pass"), ("a", "not_null", "name"): (1, "warn"), ("a", "unique", "id"): (1, "error"),
        ("a", "expression_is_true", "small"): (0, "pass"), ("a", "recency", "at"): (0, "pass"),
        ("a", "equal_rowcount", "b"): (1, "error"), ("b", "not_null", "id"): (0, "pass")}


def test_row_checks_of_a_model_share_a_pass(models):
    plan = run_checks(models, RUN, {"a": ModelChecks(not_null=("id", "name"), expressions={"small": "id < 9"})})
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


def test_a_declared_model_must_be_given(models):
    with pytest.raises(ValueError, match="b"):
        run_checks({"a": models["a"]}, RUN, DECLARED)


def test_verdicts_are_stored_before_a_failure_stops(spark, models):
    path = fresh_path(spark, "verdicts")
    assert check_and_store(models, RUN, path, DECLARED).count() == 7
    with pytest.raises(ValueError, match="unique"):
        check_and_store(models, "2024-01-03 00:00:00", path, DECLARED, stop=True)
    assert spark.read.parquet(path).groupBy().agg(F.count("*"), F.count_distinct("checked_at")).first()[:] == (14, 2)


def test_another_session_finds_the_published_version(spark):
    root = fresh_path(spark, "published")
    with pytest.raises(ValueError, match="nothing is published"):
        writers.read_snapshot(spark, root)
    writers.publish_snapshot(spark.range(3), root, "z1", "published_rows")
    writers.publish_snapshot(writers.read_snapshot(spark, root).filter("id > 0"), root, "a2", "published_rows")
    other = spark.newSession()
    assert not other.catalog.tableExists("published_rows")
    assert writers.read_snapshot(other, root).count() == 2
