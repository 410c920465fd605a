"""Month spine and the monthly contract fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanledger.functions.dates import (
    DateLike, date_lit, month_end, month_start, spine_step_from, spine_step_until,
)
from spanledger.schemas import FROM_DATE, IDENTIFIER, TO_DATE

_STEPS = {"day": "INTERVAL 1 DAY", "month": "INTERVAL 1 MONTH", "year": "INTERVAL 1 YEAR"}


def spine_from_bounds(bounds: DataFrame, start: str, end_exclusive: str, datepart: str = "month") -> DataFrame:
    """Spine for the start and exclusive end held in a one-row frame."""
    if datepart not in _STEPS:
        raise ValueError(f"unknown datepart: {datepart!r}")
    last = F.date_sub(F.col(end_exclusive), 1)
    days = F.when(last >= F.col(start), F.sequence(F.col(start), last, F.expr(_STEPS[datepart])))
    return bounds.select(F.explode(days).alias("effective_date")).select(
        "effective_date",
        month_start("effective_date").alias("effective_month"),
        month_end("effective_date").alias("month_end_date"),
    )


def date_spine(spark: SparkSession, start: DateLike, end_exclusive: DateLike, datepart: str = "month") -> DataFrame:
    """Every step from ``start`` up to, not including, ``end_exclusive``."""
    bounds = spark.range(1).select(date_lit(start).alias("s"), date_lit(end_exclusive).alias("e"))
    return spine_from_bounds(bounds, "s", "e", datepart)


def fct_contract_metrics(
    dim: DataFrame,
    territory: DataFrame,
    start: DateLike,
    end_exclusive: DateLike,
) -> DataFrame:
    """Monthly metrics per territory over the contracts valid on each spine date.

    A version is valid on a run of consecutive spine dates, so it is reduced to
    its first and last step number, cut to the spine (open ends would otherwise
    reach the year 9999), and never joined to the spine row by row. Sums, counts
    and extremes of all versions with equal (territory, first, last) combine
    map-side before anything is shuffled; only these combinations, whose number
    depends on the spine and not on the data, are spread over their months.
    Distinct contracts come from merging each contract's overlapping step runs.
    """
    first_day, end_day = date_lit(start), date_lit(end_exclusive)
    last_step = spine_step_until(first_day, F.date_sub(end_day, 1))
    runs = dim.filter((F.col(FROM_DATE) < end_day) & (F.col(TO_DATE) >= first_day)).select(
        "territory_id", IDENTIFIER, "amount",
        F.greatest(spine_step_from(first_day, F.col(FROM_DATE)), F.lit(0)).alias("_first"),
        F.least(spine_step_until(first_day, F.col(TO_DATE)), last_step).alias("_last"),
    ).filter(F.col("_first") <= F.col("_last"))

    amounts = runs.groupBy("territory_id", "_first", "_last").agg(
        F.sum("amount").alias("_sum"), F.count("amount").alias("_n"),
        F.min("amount").alias("_min"), F.max("amount").alias("_max"))
    contracts = _distinct_runs(runs).groupBy("territory_id", "_first", "_last").agg(F.count("*").alias("_contracts"))
    nothing = [F.lit(None).cast(amounts.schema[c].dataType).alias(c) for c in ("_sum", "_n", "_min", "_max")]
    steps = amounts.withColumn("_contracts", F.lit(0).cast("bigint")).unionByName(
        contracts.select("territory_id", "_first", "_last", *nothing, "_contracts"))

    monthly = (
        steps.withColumn("_step", F.explode(F.sequence("_first", "_last")))
        .groupBy("territory_id", "_step")
        .agg(
            F.sum("_contracts").alias("contract_count"),
            F.sum("_sum").alias("total_amount"),
            _average(F.sum("_sum"), F.sum("_n"), dim).alias("avg_amount"),
            F.min("_min").alias("min_amount"),
            F.max("_max").alias("max_amount"),
        )
    )
    dated = monthly.withColumn("effective_date", F.add_months(first_day, F.col("_step")))
    labels = territory.select("territory_id", "territory_name", "region", "country")
    return dated.join(labels, "territory_id", "left").select(
        month_start("effective_date").alias("effective_month"), "effective_date", "territory_id", "territory_name",
        "region", "country", "contract_count", "total_amount", "avg_amount", "min_amount", "max_amount",
    )


def _average(total: Column, count: Column, dim: DataFrame) -> Column:
    """Average of ``amount``; decimals keep 16 places instead of the few that the
    widened types of a sum of sums would leave."""
    amount = dim.schema["amount"].dataType
    if isinstance(amount, T.DecimalType):
        total = total.cast(T.DecimalType(min(38, 22 + amount.scale), amount.scale))
        count = count.cast(T.DecimalType(13, 0))
    return total / count


def _distinct_runs(runs: DataFrame) -> DataFrame:
    """Per territory and contract, step runs merged until none overlap."""
    key = ["territory_id", IDENTIFIER]
    # Equal starts merge first: at most one row per spine step enters a window group.
    by_start = runs.groupBy(*key, "_first").agg(F.max("_last").alias("_last"))
    ordered = Window.partitionBy(*key).orderBy("_first")
    reach = F.max("_last").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("_first") > reach, F.lit(True)).cast("int")
    running: Column = F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        by_start.withColumn("_opens", opens).withColumn("_run", running)
        .groupBy(*key, "_run").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    )


def contracts_by_month(dim: DataFrame, start: DateLike, end_exclusive: DateLike) -> DataFrame:
    """The detail rows behind the fact: one per version and spine date it is valid on.

    Each version lists its own months from its clipped step run (an inner range
    join on the spine without comparing every version to every month).
    """
    first_day, end_day = date_lit(start), date_lit(end_exclusive)
    last_step = spine_step_until(first_day, F.date_sub(end_day, 1))
    first = F.greatest(spine_step_from(first_day, F.col(FROM_DATE)), F.lit(0))
    last = F.least(spine_step_until(first_day, F.col(TO_DATE)), last_step)
    in_spine = dim.filter((F.col(FROM_DATE) < end_day) & (F.col(TO_DATE) >= first_day))
    stepped = in_spine.withColumn("_first", first).withColumn("_last", last).filter("_first <= _last")
    dated = stepped.withColumn("_step", F.explode(F.sequence("_first", "_last")))
    return dated.withColumn("effective_date", F.add_months(first_day, F.col("_step"))).select(
        month_start("effective_date").alias("effective_month"), "effective_date", IDENTIFIER, "contract_id",
        "territory_id", "external_contract_id", "amount", "interest_date")

