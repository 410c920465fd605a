import random

import numpy as np
import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from spanledger.operators import profiling
from spanledger.operators.anomalies import kmeans_anomalies, kmeans_distances
from spanledger.plans.profiling_run import data_profiling


@pytest.fixture(scope="module")
def data():
    """A third of all values equal, NULLs, text numbers, an empty column."""
    rnd = random.Random(5)
    out = []
    for i in range(900):
        x = 7.0 if i % 3 == 0 else rnd.uniform(-50, 50)
        y = None if i % 10 == 0 else 2 * x + rnd.gauss(0, 3)
        text = rnd.choice(["12", " 3.5 ", "-1e2", "abc", "", "n/a", "NaN-ish"])
        out.append((i, x, y, text, None))
    return out


@pytest.fixture(scope="module")
def df(spark, data):
    return spark.createDataFrame(data, "id long, x double, y double, t string, e double").repartition(6)


def column(data, i):
    return np.array([r[i] for r in data if r[i] is not None], dtype=float)


def test_exact_quantiles_equal_numpy(df, data):
    ps = [0.0, 0.1, 0.25, 0.333, 0.5, 0.75, 0.999, 1.0]
    found = {(r.column_name, r.probability): r.value
             for r in profiling.exact_quantiles(df, ["x", "y", "t", "e"], ps).collect()}
    texts = np.array([12.0 if r[3] == "12" else 3.5 if r[3] == " 3.5 " else -100.0
                      for r in data if r[3] in ("12", " 3.5 ", "-1e2")])
    for name, values in (("x", column(data, 1)), ("y", column(data, 2)), ("t", texts)):
        for p in ps:
            assert found[name, p] == pytest.approx(np.quantile(values, p), abs=1e-9)
    assert not [k for k in found if k[0] == "e"]


def test_quantiles_of_one_row_and_none(spark):
    one = spark.createDataFrame([(4.0,)], "x double")
    assert profiling.quartile_columns(one, ["x"]).first()[1:] == (4.0, 4.0, 4.0)
    assert profiling.quartile_columns(one.limit(0), ["x"]).count() == 0


@pytest.fixture(scope="module")
def many(spark):
    """More values than go without brackets: spread, a few that repeat, one for a third of all, infinite ones and NaN."""
    rng = np.random.default_rng(3)
    n = 30_000
    spread = rng.normal(0, 100, n)
    few = rng.integers(0, 5, n).astype(float)
    hot = np.where(np.arange(n) % 3 == 0, 1.5, spread)
    odd = spread.copy()
    odd[:6000], odd[6000:9000], odd[9000:12000] = np.nan, np.inf, -np.inf
    values = {"spread": spread, "few": few, "hot": hot, "odd": odd}
    rows_ = [tuple(float(v[i]) for v in values.values()) for i in range(n)]
    return spark.createDataFrame(rows_, "spread double, few double, hot double, odd double").repartition(6), values


@pytest.mark.parametrize("margin", [profiling.BRACKET_MARGIN, 0.0, -0.2])
def test_bracketed_quantiles_equal_numpy_even_when_brackets_miss(many, monkeypatch, margin):
    df, values = many
    monkeypatch.setattr(profiling, "BRACKET_MARGIN", margin)
    ps = [0.0, 0.001, 0.25, 0.333, 0.5, 0.75, 0.999, 1.0]
    found = {(r.column_name, r.probability): r.value for r in profiling.exact_quantiles(df, list(values), ps).collect()}
    assert len(found) == len(ps) * len(values)
    for name in ("spread", "few", "hot"):
        for p in ps:
            assert found[name, p] == pytest.approx(np.quantile(values[name], p), abs=1e-9), (name, p)
    ordered = np.sort(values["odd"])  # NaN last
    for p in (0.25, 0.333, 0.5):
        at = p * (len(ordered) - 1)
        low, high = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
        assert found["odd", p] == pytest.approx(low + (high - low) * (at % 1))
    assert np.isnan(found["odd", 1.0]) and np.isnan(found["odd", 0.999])


def test_only_values_near_a_wanted_rank_are_shuffled(many):
    brackets, totals = profiling._sketched_brackets(many[0], ["spread"], [0.25, 0.5])
    assert totals == {"spread": 30_000}
    inside = [((many[1]["spread"] >= b.low) & (many[1]["spread"] <= b.high)).sum() for b in brackets]
    assert len(inside) == 2 and max(inside) < 0.03 * 30_000


def test_sketch_stays_near_the_exact_value(df, data):
    x = np.sort(column(data, 1))
    for r in profiling.sketch_quantiles(df, ["x"], [0.25, 0.5, 0.75]).collect():
        rank = np.searchsorted(x, r.value, side="left"), np.searchsorted(x, r.value, side="right")
        assert rank[0] - 1 <= r.probability * len(x) <= rank[1] + 1


def test_boundaries_run_from_minimum_to_maximum(df, data):
    for quantiles in ("approx", "exact"):
        found = profiling.quartile_boundaries(df, ["x"], quantiles).first().quartiles
        assert len(found) == 5 and found == sorted(found)
        assert (found[0], found[4]) == (column(data, 1).min(), column(data, 1).max())


@pytest.mark.parametrize("options", [
    {}, {"chunk": None}, {"chunk": 1}, {"distinct": "approx"}, {"quantiles": "exact"}])
def test_profile(df, data, options):
    found = {r.column_name: r for r in profiling.profile_columns(df, stats=True, **options).collect()}
    assert list(found) == ["e", "id", "t", "x", "y"]
    y = column(data, 2)
    assert (found["y"].total_count, found["y"].null_count) == (900, 90)
    if "distinct" not in options:
        assert found["y"].distinct_count == len(set(y)) and found["t"].distinct_count == 7
    assert found["y"].avg_value == pytest.approx(y.mean()) and found["y"].stddev_value == pytest.approx(y.std(ddof=1))
    assert float(found["y"].min_value) == y.min()
    assert (found["t"].min_value, found["t"].max_value) == ("", "n/a")
    assert (found["t"].min_number, found["t"].max_number) == (-100.0, 12.0) and found["y"].max_number == y.max()
    assert (found["e"].distinct_count, found["e"].null_count, found["e"].avg_value) == (0, 900, None)
    assert found["id"].data_type == "bigint" and found["id"].max_value == "899"
    if options.get("quantiles") == "exact":
        assert found["y"].q3 == pytest.approx(np.quantile(y, 0.75)) and found["e"].q1 is None
        assert found["y"].median_value == found["y"].q2


def test_profile_rejects_unknown_modes(df):
    with pytest.raises(ValueError):
        profiling.profile_columns(df, distinct="guess")


def test_text_is_read_as_a_number_exactly_when_a_cast_would(spark):
    texts = ["1", "-1", "+1.5", ".5", "5.", "1e3", "1E-2", " 7 ", "nan", "NaN", "inf", "-Infinity", "+inf",
             "", " ", "abc", "1a", "1 2", "--1", "e3", ".", "0x1F", "١"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = df.select("t", profiling.as_double(df, "t").alias("a"), F.col("t").try_cast("double").alias("b"))
    assert both.filter(~F.col("a").eqNullSafe(F.col("b"))).collect() == []


def test_codes_with_a_suffix_are_no_numbers(spark):
    df = spark.createDataFrame([("10F",), ("12D",), ("1d",), ("7",)], "t string")
    assert [r[0] for r in df.select(profiling.as_double(df, "t")).collect()] == [None, None, None, 7.0]


def test_outliers(spark):
    df = spark.createDataFrame([(i, float(i % 10), 500.0 if i == 3 else 1.0 * i) for i in range(100)] + [(100, -90.0, None)],
                               "id int, a double, b double")
    for quantiles in ("approx", "exact"):
        found = profiling.iqr_outliers(df, ["a", "b"], carry=["id"], quantiles=quantiles)
        assert rows(found, "id", "column_name", "value") == [(100, "a", -90.0), (3, "b", 500.0)]
    bounds = profiling.iqr_outliers(df, ["b"], carry=["id"], quantiles="exact").first()
    q1, q3 = np.quantile([500.0 if i == 3 else i for i in range(100)], [0.25, 0.75])
    assert bounds.upper_bound == pytest.approx(q3 + 1.5 * (q3 - q1))
    assert profiling.iqr_outliers(df, ["b"], k=50, quantiles="exact").count() == 0


def test_correlation(df, data):
    pairs = {(r.col1, r.col2): r.correlation_score for r in profiling.correlation_matrix(df, ["x", "y", "id"]).collect()}
    assert set(pairs) == {("x", "y"), ("x", "id"), ("y", "id")}
    both = np.array([(r[1], r[2]) for r in data if r[2] is not None])
    assert pairs["x", "y"] == pytest.approx(np.corrcoef(both.T)[0, 1])


def test_skewness_and_log(spark):
    values = [0.5 * i * i for i in range(40)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    row = profiling.skewness_summary(df, ["x"]).first()

    def skew(v):
        d = np.array(v) - np.mean(v)
        return (d ** 3).mean() / (d ** 2).mean() ** 1.5

    assert row.total_records == 41
    assert row.skewness == pytest.approx(skew(values)) and row.log_skewness == pytest.approx(skew(np.log1p(values)))
    low = spark.createDataFrame([(-1.0,), (-2.0,), (0.0,)], "x double")
    assert rows(profiling.log_transform(low, ["x"]), "x_log") == [(0.0,), (None,), (None,)]


def test_kmeans_distances_equal_numpy(df):
    scored = kmeans_distances(df, ["x", "y"], k=3, carry=["id"]).toPandas()
    assert len(scored) == 810
    features = scored[["x", "y"]].to_numpy()
    z = (features - features.mean(axis=0)) / features.std(axis=0, ddof=1)
    for label in scored.cluster_label.unique():
        mine = (scored.cluster_label == label).to_numpy()
        expected = np.linalg.norm(z[mine] - z[mine].mean(axis=0), axis=1)
        # The model's centres are the means of the clusters up to its tolerance.
        assert np.allclose(scored.distance[mine], expected, atol=0.05)


def test_farthest_rows(df):
    top = kmeans_anomalies(df, ["x", "y"], top=5, carry=["id"], standardize=False).collect()
    every = kmeans_distances(df, ["x", "y"], carry=["id"], standardize=False).toPandas()
    assert [r.id for r in top] == list(every.sort_values("distance", ascending=False).id[:5])


def test_fit_in_parts(spark, df, monkeypatch, tmp_path):
    """A table read by one task is fitted in parts of bounded size; the clusters are the same."""
    import pyspark.ml.base as base

    from spanledger.operators import anomalies
    from spanledger.operators.stored_model import fit_and_store

    fit, parts = base.Estimator.fit, []

    def watched(self, dataset, params=None):
        parts.append(max(r[0] for r in dataset.groupBy(F.spark_partition_id()).count().select("count").collect()))
        return fit(self, dataset, params)

    one = df.coalesce(1)
    whole = rows(anomalies.kmeans_distances(one, ["x", "y"], carry=["id"]).select("id", F.round("distance", 1)))
    monkeypatch.setattr(base.Estimator, "fit", watched)
    monkeypatch.setattr(anomalies, "FIT_ROWS", 100, raising=False)
    for standardize in (True, False):
        scored = anomalies.kmeans_distances(one, ["x", "y"], carry=["id"], standardize=standardize)
        assert scored.count() == 810 and (not standardize or rows(scored.select("id", F.round("distance", 1))) == whole)
    fit_and_store(one, ["x", "y"], str(tmp_path), "v1")
    assert len(parts) >= 3 and max(parts) < 200


def test_whole_profile(df):
    out = data_profiling(df, clusters=2, carry=["id"], columns=["x", "y", "t"])
    assert set(out) == {"column_summary", "quartiles", "outliers", "skewness", "log_values", "correlation", "anomalies"}
    assert out["column_summary"].count() == 3 and out["correlation"].count() == 1 and out["anomalies"].count() == 10


def test_chunks_read_their_own_columns_only(spark):
    from conftest import SF_DIR

    lineitem = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    plan = final_plan(profiling.profile_columns(lineitem, ["l_tax", "l_discount"], chunk=1))
    assert "ReadSchema: struct<l_tax:double>" in plan and "ReadSchema: struct<l_discount:double>" in plan


def test_tables_without_numbers(spark):
    days = spark.sql("select date '2024-01-01' as d, true as b union all select null, false")
    for quantiles in ("approx", "exact"):
        found = profiling.profile_columns(days, stats=True, quantiles=quantiles).collect()
        assert [(r.column_name, r.distinct_count, r.max_value, r.q1) for r in found] == [
            ("b", 2, None, None), ("d", 1, "2024-01-01", None)]
    assert set(data_profiling(days, clusters=2)) == {"column_summary"}
