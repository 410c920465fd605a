import pytest
from conftest import rows

from spanledger.operators import quality


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [(1, "a", 5, "2024-01-01 00:00:00"), (1, "b", None, "2024-01-02 12:00:00"), (2, None, 7, None), (None, None, 1, None)],
        "k int, s string, n int, t string").selectExpr("k", "s", "n", "cast(t as timestamp) as t")


def verdicts(df):
    return [(r.check_name, r.subject, r.failures, r.status) for r in df.orderBy("subject").collect()]


def test_not_null(df):
    assert verdicts(quality.not_null(df, ["k", "s", "n"], "warn")) == [
        ("not_null", "k", 1, "warn"), ("not_null", "n", 1, "warn"), ("not_null", "s", 2, "warn")]


def test_unique(df):
    assert verdicts(quality.unique(df, ["k"])) == [("unique", "k", 1, "error")]
    assert verdicts(quality.unique(df, ["k", "s"])) == [("unique", "k, s", 0, "pass")]
    assert rows(quality.duplicate_keys(df, ["k"])) == [(1, 2)]


def test_expressions(df):
    out = quality.expression_is_true(df, {"small": "n < 6", "any": "true"})
    assert verdicts(out) == [("expression_is_true", "any", 0, "pass"), ("expression_is_true", "small", 2, "error")]
    assert quality.failing_rows(df, "n < 6").count() == 2


def test_recency_and_freshness(df):
    def status(run_ts, **options):
        return quality.recency(df, "t", run_ts, **options).first().status

    assert status("2024-01-03 12:00:00") == "pass" and status("2024-01-03 12:00:01") == "error"
    assert status("2024-01-03 12:00:01", amount=2, severity="warn") == "pass"
    assert status("2024-02-10 00:00:00", amount=1, datepart="month", severity="warn") == "warn"
    assert quality.recency(df.filter("t is null"), "t", "2024-01-01").first().status == "error"
    fresh = [quality.source_freshness(df, "t", t).first() for t in
             ("2024-01-03 12:00:00", "2024-01-03 12:00:01", "2024-01-04 12:00:01")]
    assert [f.status for f in fresh] == ["pass", "warn", "error"] and fresh[0].age_hours == 24.0
    assert quality.source_freshness(df.limit(0), "t", "2024-01-01").first().status == "error"


def test_row_counts_report_and_stop(df):
    equal, less = quality.equal_rowcount(df, df, "a"), quality.equal_rowcount(df, df.limit(1), "b")
    assert verdicts(quality.report(equal, less)) == [("equal_rowcount", "a", 0, "pass"), ("equal_rowcount", "b", 3, "error")]
    quality.must_pass(quality.report(equal, quality.equal_rowcount(df, df.limit(1), "b", "warn")))
    with pytest.raises(ValueError, match="equal_rowcount"):
        quality.must_pass(less)
    with pytest.raises(ValueError):
        quality.not_null(df, ["k"], "fatal")
