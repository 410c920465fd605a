"""A complete profile of one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from spanledger.operators import profiling
from spanledger.operators.anomalies import kmeans_anomalies
from spanledger.sources.scratch import durable


def data_profiling(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    distinct: str = "exact",
    quantiles: str = "approx",
    clusters: int | None = None,
    carry: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """Named result frames, which run when they are used.

    Two things run at the call: ``quantiles="exact"`` finds the boundaries of all
    columns once and stores these few rows for summary, quartiles and outliers;
    ``clusters`` trains a k-means model.
    """
    numeric = [c for c in (columns or df.columns) if c in profiling.numeric_columns(df)]
    castable = [c for c in (columns or df.columns) if c in profiling.castable_columns(df)]
    found = None
    if quantiles == "exact" and castable:
        found = durable(profiling.exact_quantiles(df, castable, profiling.BOUNDARIES), "boundaries")
    out = {"column_summary": profiling.profile_columns(df, columns, True, distinct, quantiles, found=found)}
    if numeric:
        out |= {
            "quartiles": profiling.quartile_boundaries(df, numeric, quantiles, found),
            "outliers": profiling.iqr_outliers(df, numeric, carry=carry, quantiles=quantiles, found=found),
            "skewness": profiling.skewness_summary(df, numeric),
            "log_values": profiling.log_transform(df, numeric),
        }
    if len(numeric) > 1:
        out["correlation"] = profiling.correlation_matrix(df, numeric)
    if clusters and numeric:
        out["anomalies"] = kmeans_anomalies(df, numeric, clusters, carry=carry)
    return out
