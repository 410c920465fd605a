"""Every registered query against its SQL twin, and rules for all their plans."""

import re

import pytest
from conftest import SF_DIR
from oracle_check import connect, differences

from spanledger.workloads.oracles import ORACLES
from spanledger.workloads.queries import QUERIES

ROWS_ONLY = {"kmeans_anomalies_top"}
UNSCALABLE = re.compile(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython|MapInPandas")


LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def sql():
    """Connections to the smallest tables and to larger ones, for twins that find nothing in the smallest."""
    return {sf_dir: connect(sf_dir) for sf_dir in (SF_DIR, LARGER)}


def telling_dir(sql, twin):
    """The smallest tables in which a twin has rows; equal empty results would prove nothing."""
    for sf_dir, con in sql.items():
        if con.execute(f"SELECT count(*) FROM ({twin})").fetchone()[0]:
            return sf_dir
    raise AssertionError("the twin has no rows")


def test_every_query_has_a_twin_or_is_listed():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    sf_dir = telling_dir(sql, ORACLES[name]) if name in ORACLES else SF_DIR
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not UNSCALABLE.search(plan), plan
    if name in ORACLES:
        assert differences(df, sql[sf_dir], ORACLES[name]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert __spark_entry__.queries().keys() >= __spark_entry__.oracle_sql().keys()
