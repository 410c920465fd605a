"""k-means models that are fitted once, stored in versions, and used later on rows that were not there.

A version is a saved pipeline (features to one vector, standardisation, k-means) below ``version=…``; a pointer names the
one published last. Scores are column arithmetic with the stored centres, so no row passes through Python or the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.operators.anomalies import parts_for_fit
from spanledger.operators.profiling import with_numbers
from spanledger.sources.writers import current_version, point_to_version


class CentreModel(NamedTuple):
    """The numbers of a stored model: features, their means and deviations, and the centres in standard units."""

    version: str
    columns: list[str]
    means: list[float]
    deviations: list[float]
    centres: list[list[float]]


def _model_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/version={version}"


def fit_and_store(df: DataFrame, columns: Sequence[str], root: str, version: str, k: int = 3, seed: int = 42, max_iter: int = 20) -> CentreModel:
    """Fit k-means to the rows that have all features, save it as a version and publish it.

    Text features are read as numbers. A version that exists already is an error, and a failed fit or save leaves the old
    version published.
    """
    spark, numbers = df.sparkSession, with_numbers(df, columns).dropna()
    pipeline = Pipeline(stages=[
        VectorAssembler(inputCols=list(columns), outputCol="raw_vector"),
        StandardScaler(inputCol="raw_vector", outputCol="vector", withMean=True, withStd=True),
        KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="vector", predictionCol="cluster_label")])
    pipeline.fit(parts_for_fit(numbers, numbers.count())).save(_model_path(root, version))
    point_to_version(spark, root, version)
    return load_model(spark, root, version)


def load_model(spark: SparkSession, root: str, version: str | None = None) -> CentreModel:
    """A version, by default the one published last, from any session."""
    version = version or current_version(spark, root)
    if version is None:
        raise ValueError(f"no model is published in {root}")
    assembler, scaler, kmeans = PipelineModel.load(_model_path(root, version)).stages
    return CentreModel(version, assembler.getInputCols(), scaler.mean.toArray().tolist(), scaler.std.toArray().tolist(),
                       [c.tolist() for c in kmeans.clusterCenters()])


def score_with(df: DataFrame, model: CentreModel, carry: Sequence[str] = ()) -> DataFrame:
    """``carry``, the features, cluster_label, distance to that centre and model_version for every row with all features.

    The label is that of the nearest centre, the first on ties. A feature that was constant when the model was fitted
    adds nothing to distances.
    """
    numbers = with_numbers(df, model.columns, carry).dropna(subset=model.columns)
    scaled = [(F.col(f"`{c}`") - m) / d if d else F.lit(0.0) for c, m, d in zip(model.columns, model.means, model.deviations)]
    squares = [reduce(lambda a, b: a + b, [F.pow(s - x, F.lit(2)) for s, x in zip(scaled, centre)]) for centre in model.centres]
    near = numbers.withColumn("_squares", F.array(*squares)).withColumn("_least", F.array_min("_squares"))
    return near.select(
        *carry, *[F.col(f"`{c}`") for c in model.columns], (F.array_position("_squares", F.col("_least")) - 1).cast("int").alias("cluster_label"),
        F.sqrt("_least").alias("distance"), F.lit(model.version).alias("model_version"))


def farthest(df: DataFrame, model: CentreModel, top: int = 10, carry: Sequence[str] = ()) -> DataFrame:
    """The ``top`` rows farthest from their centre."""
    return score_with(df, model, carry).orderBy(F.desc("distance"), *carry).limit(top)
