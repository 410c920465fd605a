import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from spanledger.session import build_session

    session = build_session("spanledger-tests", "local[*]", **{
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_conf(**options):
        for key, value in options.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_conf
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def final_plan(df) -> str:
    """The plan as executed, after adaptive re-planning."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    return plan.toString()


def rows(df, *columns):
    """Sorted tuples, for comparisons."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)
