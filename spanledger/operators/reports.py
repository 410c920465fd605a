"""Reports over the version history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.functions.dates import date_lit
from spanledger.operators.ordering import HOT_GROUP_ROWS, lag_in_group
from spanledger.schemas import CONTRACT_KEY, FROM_DATE, IDENTIFIER, OPEN_END, TO_DATE

# Labels of the change report.
NEW_RECORD = "New Record"
AMOUNT_CHANGED = "Amount Changed"
OTHER_CHANGE = "Other Change"


def active_contracts(final: DataFrame, open_end: str = OPEN_END) -> DataFrame:
    return final.filter(F.col(TO_DATE) == date_lit(open_end))


def contract_history(final: DataFrame, contract_id: int, territory_id: int) -> DataFrame:
    """All versions of one contract, oldest first."""
    wanted = (F.col("contract_id") == contract_id) & (F.col("territory_id") == territory_id)
    return final.filter(wanted).orderBy(FROM_DATE)


def contract_versions(final: DataFrame) -> DataFrame:
    return final.select(IDENTIFIER, *CONTRACT_KEY, "amount", FROM_DATE, TO_DATE).orderBy(IDENTIFIER, FROM_DATE)


def identifier_listing(id_map: DataFrame) -> DataFrame:
    return id_map.select(*CONTRACT_KEY, IDENTIFIER)


def territory_contract_count(final: DataFrame) -> DataFrame:
    return (
        active_contracts(final).groupBy("territory_id")
        .agg(F.count_distinct(IDENTIFIER).alias("contract_count"))
        .orderBy("territory_id")
    )


def territory_amount(final: DataFrame) -> DataFrame:
    total = F.sum("amount")
    return (
        active_contracts(final).groupBy("territory_id")
        .agg(total.alias("total_amount"),
             F.concat(F.lit("$"), F.format_number(total, 2)).alias("formatted_amount"))
        .orderBy("territory_id")
    )


def change_history(final: DataFrame, hot_limit: int = HOT_GROUP_ROWS) -> DataFrame:
    """Each version with the amount before it and a label for what changed.

    Versions starting on the same day are ordered by their end, then amount.
    """
    versions = final.select(IDENTIFIER, *CONTRACT_KEY, "amount", FROM_DATE, TO_DATE)
    lagged = lag_in_group(
        versions, [IDENTIFIER], [FROM_DATE, TO_DATE, "amount"], "amount", "previous_amount", hot_limit)
    previous = F.col("previous_amount")
    label = (
        F.when(previous.isNull(), NEW_RECORD)
        .when(F.col("amount") != previous, AMOUNT_CHANGED)
        .otherwise(OTHER_CHANGE)
    )
    return lagged.withColumn("change_type", label).select(
        IDENTIFIER, *CONTRACT_KEY, "amount", "previous_amount", "change_type", FROM_DATE, TO_DATE
    ).orderBy(IDENTIFIER, FROM_DATE, TO_DATE)
