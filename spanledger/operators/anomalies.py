"""Distance-based anomalies from a k-means model."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.operators.profiling import with_numbers

# Rows of the fit that one task holds: k-means caches them as objects, many times larger than in files.
FIT_ROWS = 1_000_000


def parts_for_fit(rows: DataFrame, n_rows: int) -> DataFrame:
    """The rows dealt evenly in parts of about ``FIT_ROWS``; not more rows than that in all stay as they are read.

    k-means draws its first centres by the place of a row in its part. The rows of a part are brought in their first order
    again, as a shuffle brings them in any and two fits of the same rows would differ.
    """
    if n_rows <= FIT_ROWS:
        return rows
    n_parts = max(-(-n_rows // FIT_ROWS), rows.sparkSession.sparkContext.defaultParallelism)
    placed = rows.withColumn("_place", F.monotonically_increasing_id()).repartition(n_parts, "_place")
    return placed.sortWithinPartitions("_place").drop("_place")


def kmeans_distances(
    df: DataFrame,
    columns: Sequence[str],
    k: int = 3,
    carry: Sequence[str] = (),
    standardize: bool = True,
    seed: int = 42,
    max_iter: int = 20,
) -> DataFrame:
    """Cluster label, distance to its centre and to the nearest centre for every row with all features.

    Features are brought to unit variance first unless ``standardize`` is off.
    Only the k centres come to the driver; distances are column arithmetic.
    """
    numbers = with_numbers(df, columns, carry).dropna(subset=list(columns))
    inputs = [f"_f{i}" for i in range(len(columns))]
    if standardize:
        moments = numbers.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{f.__name__}_{i}") for i, c in enumerate(columns)
                                for f in (F.avg, F.stddev_samp)]).first()
        scaled = {}
        for i, c in enumerate(columns):
            mean, deviation = moments[f"avg_{i}"], moments[f"stddev_samp_{i}"]
            scaled[inputs[i]] = (F.col(c) - F.lit(mean)) / F.lit(deviation or 1.0)
        numbers, n_rows = numbers.withColumns(scaled), moments["n"]
    else:
        n_rows = numbers.count()
        numbers = numbers.withColumns({f: F.col(c) for f, c in zip(inputs, columns)})
    assembler = VectorAssembler(inputCols=inputs, outputCol="_vector")
    vectors = assembler.transform(numbers)
    fitted = assembler.transform(parts_for_fit(numbers.select(*inputs), n_rows))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="_vector", predictionCol="cluster_label").fit(fitted)
    centres = model.clusterCenters()
    squares = [reduce(lambda a, b: a + b, [F.pow(F.col(f) - float(x), 2) for f, x in zip(inputs, c)]) for c in centres]
    labelled = model.transform(vectors).withColumn("_squares", F.array(*squares))
    return labelled.select(*carry, *columns, "cluster_label",
                           F.sqrt(F.get("_squares", F.col("cluster_label"))).alias("distance"),
                           F.sqrt(F.array_min("_squares")).alias("nearest_distance"))


def kmeans_anomalies(
    df: DataFrame, columns: Sequence[str], k: int = 3, top: int = 10, carry: Sequence[str] = (), **options
) -> DataFrame:
    """The ``top`` rows farthest from their cluster centre."""
    far = kmeans_distances(df, columns, k, carry, **options).drop("nearest_distance")
    return far.orderBy(F.col("distance").desc(), *carry).limit(top)
