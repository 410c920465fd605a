"""Audited writes: what is shown, what is put aside, and what a failure leaves."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from spanledger.plans.audited_write import Audit, read_audits, read_published, read_quarantine, write_audited
from spanledger.plans.checks import ModelChecks
from spanledger.sources.scratch import fresh_path

CHECKS = ModelChecks(not_null=("id",), expressions={"positive": "v > 0", "small": "v < 100"}, unique=(("id",),), warn=("small",))


@pytest.fixture
def root(spark):
    return fresh_path(spark, "audited")


def data(spark, *values):
    return spark.createDataFrame(list(values), "id long, v long")


def test_split_count_and_publish(spark, root):
    first = data(spark, (1, 5), (2, 500), (3, -1), (None, None), (None, 7))
    assert write_audited(first, root, "a", CHECKS) == Audit(False, 2, 3)
    with pytest.raises(ValueError, match="nothing is published"):
        read_published(spark, root)
    assert write_audited(first, root, "b", CHECKS, tolerance=0.6) == Audit(True, 2, 3)
    assert rows(read_published(spark, root)) == [(1, 5), (2, 500)]
    aside = {(r["id"], r["v"]): r["failed_checks"] for r in read_quarantine(spark, root, "a").collect()}
    assert aside == {(3, -1): ["expression_is_true(positive)"], (None, 7): ["not_null(id)"],
                     (None, None): ["not_null(id)", "expression_is_true(positive)", "expression_is_true(small)"]}
    found = rows(read_audits(spark, root).filter("version = 'b'"), "check_name", "subject", "failures", "status", "published")
    assert found == sorted([("not_null", "id", 2, "error", True), ("expression_is_true", "positive", 2, "error", True),
                            ("expression_is_true", "small", 2, "warn", True), ("unique", "id", 0, "pass", True)], key=str)


def test_a_bad_version_leaves_the_old_one(spark, root):
    write_audited(data(spark, (1, 1)), root, "a", CHECKS)
    assert not write_audited(data(spark, (2, 2), (2, 3)), root, "b", CHECKS).published   # repeated key
    assert not write_audited(data(spark, (2, -2)), root, "c", CHECKS).published          # bad row
    assert rows(read_published(spark, root)) == [(1, 1)]
    assert write_audited(data(spark, (2, 2)), root, "d", CHECKS).published
    assert rows(read_published(spark, root)) == [(2, 2)]
    with pytest.raises(Exception, match="(?i)already exists"):
        write_audited(data(spark, (9, 9)), root, "d", CHECKS)
    assert rows(read_published(spark, root)) == [(2, 2)]


def test_repeats_among_quarantined_rows_do_not_count(spark, root):
    assert write_audited(data(spark, (1, 1), (1, -1), (1, -2)), root, "a", CHECKS, tolerance=1.0) == Audit(True, 1, 2)


def test_a_failing_write_shows_nothing(spark, root):
    write_audited(data(spark, (1, 1)), root, "a", CHECKS)
    broken = data(spark, (2, 2)).withColumn("v", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        write_audited(broken, root, "b", CHECKS)
    assert rows(read_published(spark, root)) == [(1, 1)]
    assert rows(read_audits(spark, root).select("version").distinct()) == [("a",)]


def test_source_is_read_once(spark, root):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    source = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("v")).mapInArrow(count, "id long, v long")
    assert write_audited(source, root, "a", CHECKS, tolerance=1.0).n_quarantined == 143
    assert seen.value == 1000


def test_empty_rows_no_checks_and_clashing_names(spark, root):
    assert write_audited(data(spark), root, "a", CHECKS) == Audit(True, 0, 0)
    assert write_audited(data(spark, (1, 1)), root, "b", ModelChecks()) == Audit(True, 1, 0)
    assert rows(read_published(spark, root)) == [(1, 1)]
    with pytest.raises(ValueError, match="audit adds"):
        write_audited(data(spark, (1, 1)).withColumnRenamed("v", "failed_checks"), root, "c", ModelChecks())
