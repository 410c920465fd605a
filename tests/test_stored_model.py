"""Stored k-means models: scores from another session, versions, and odd rows."""

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from spanledger.operators.stored_model import farthest, fit_and_store, load_model, score_with
from spanledger.sources.scratch import fresh_path


@pytest.fixture
def root(spark):
    return fresh_path(spark, "model")


def points(spark, *extra):
    """Three clouds of ten points on a line each, and a text feature."""
    data = [(i, 100.0 * (i % 3) + i / 10, str(50 * (i % 3)), 7.0) for i in range(30)] + list(extra)
    return spark.createDataFrame(data, "id long, x double, y string, same double")


def test_scores_from_another_session(spark, root):
    df = points(spark)
    model = fit_and_store(df, ["x", "y"], root, "a")
    again = load_model(spark.newSession(), root)
    assert again == model and model.version == "a" and model.columns == ["x", "y"]
    first, second = (rows(score_with(df, m, ["id"])) for m in (model, again))
    assert first == second and len(first) == 30
    labels = {r["id"] % 3: r["cluster_label"] for r in score_with(df, model, ["id"]).collect()}
    assert sorted(labels.values()) == [0, 1, 2]


def test_distances(spark, root):
    """By hand: standard units, the nearest centre, the farthest row first."""
    df = points(spark)
    model = fit_and_store(df, ["x", "y", "same"], root, "a")
    assert model.deviations[2] == 0
    new = spark.createDataFrame([(1, 0.0, "0", 7.0), (2, 1e4, "100", 99.0), (3, None, "1", 7.0), (4, 1.0, "word", 7.0)], "id long, x double, y string, same double")
    got = {r["id"]: r for r in score_with(new, model, ["id"]).collect()}
    assert set(got) == {1, 2}
    for i, values in ((1, (0.0, 0.0)), (2, (1e4, 100.0))):
        scaled = [(v - m) / d for v, m, d in zip(values, model.means, model.deviations)]
        apart = [math.sqrt(sum((s - c) ** 2 for s, c in zip(scaled, centre))) for centre in model.centres]
        assert got[i]["distance"] == pytest.approx(min(apart)) and got[i]["cluster_label"] == apart.index(min(apart))
    assert rows(farthest(new, model, 1, ["id"]), "id") == [(2,)]


def test_versions(spark, root):
    with pytest.raises(ValueError, match="no model"):
        load_model(spark, root)
    fit_and_store(points(spark), ["x"], root, "a")
    fit_and_store(points(spark), ["x"], root, "b", k=2)
    assert len(load_model(spark, root).centres) == 2 and len(load_model(spark, root, "a").centres) == 3
    with pytest.raises(Exception):
        fit_and_store(points(spark), ["x"], root, "b", k=4)
    with pytest.raises(Exception):
        fit_and_store(points(spark).withColumn("x", F.raise_error(F.lit("lost")).cast("double")), ["x"], root, "c")
    assert load_model(spark, root).version == "b" and len(load_model(spark, root).centres) == 2
