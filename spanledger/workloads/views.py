"""Contract, record and reference views derived from the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanledger.functions.dates import date_lit, ts_lit
from spanledger.operators.identifiers import assign_ids
from spanledger.operators.scd2 import initial_load
from spanledger.schemas import CONTRACT_COLUMNS, FROM_DATE, OPEN_END, TERRITORY_REFERENCE, TO_DATE
from spanledger.sources.readers import inline_rows, read_table
from spanledger.sources.scratch import durable

RUN_DATE = "2001-12-31"
RUN_TS = "2001-12-31 06:00:00"
RECORD_EPOCH = "2024-01-01 00:00:00"

# The territory reference seed.
TERRITORIES = [
    (100, "Northeast", "East", "USA"),
    (101, "Southeast", "East", "USA"),
    (102, "Midwest", "Central", "USA"),
    (103, "Southwest", "West", "USA"),
    (104, "West", "West", "USA"),
    (105, "Canada East", "North", "Canada"),
    (106, "Canada West", "North", "Canada"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def territory_reference(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, TERRITORIES, TERRITORY_REFERENCE)


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragmented ranges: one per order, months long, some open-ended."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    first = F.trunc(F.to_date("o_orderdate"), "month")
    months = (F.col("o_orderkey") % 12).cast("int")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(
        F.col("o_custkey").alias("contract_id"),
        (100 + F.col("o_custkey") % 7).alias("territory_id"),
        F.concat(F.lit("EXT"), F.col("o_custkey"), F.lit("-"), F.substring("o_orderpriority", 1, 1))
        .alias("external_contract_id"),
        F.round("c_acctbal", 2).cast("decimal(12,2)").alias("amount"),
        date_lit("2001-12-31").alias("interest_date"),
        first.alias(FROM_DATE),
        F.when(F.col("o_orderkey") % 11 == 0, date_lit(OPEN_END))
        .otherwise(F.last_day(F.add_months(first, months))).alias(TO_DATE),
    )


def timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean history: one version per customer and order day, the last one open."""
    daily = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.to_date("o_orderdate").alias(FROM_DATE))
        .agg(F.max("o_totalprice").alias("price"))
    )
    # Grouped by day, so one customer's window holds at most a row per calendar day.
    following = F.lead(FROM_DATE).over(Window.partitionBy("o_custkey").orderBy(FROM_DATE))
    return daily.select(
        F.col("o_custkey").alias("contract_id"),
        (100 + F.col("o_custkey") % 7).alias("territory_id"),
        F.concat(F.lit("EXT"), F.col("o_custkey")).alias("external_contract_id"),
        F.col("price").cast("decimal(12,2)").alias("amount"),
        F.col(FROM_DATE).alias("interest_date"),
        FROM_DATE,
        F.coalesce(F.date_sub(following, 1), date_lit(OPEN_END)).alias(TO_DATE),
    )


def day2(spark: SparkSession, sf_dir: str, history: DataFrame | None = None) -> DataFrame:
    """The next feed: open versions with some attributes changed, and new contracts.

    Customers of the FURNITURE segment do not report on that day; suppliers come
    in as new contracts. ``history`` is the timeline where it is already stored.
    """
    key = F.col("contract_id")
    reporting = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "FURNITURE").select(
        F.col("c_custkey").alias("contract_id"))
    is_open = F.col(TO_DATE) == date_lit(OPEN_END)
    history = timeline(spark, sf_dir) if history is None else history
    known = history.filter(is_open).join(reporting, "contract_id", "left_semi").select(
        "contract_id", "territory_id", "external_contract_id",
        F.when(key % 5 == 0, F.col("amount") + 50).otherwise(F.col("amount")).cast("decimal(12,2)").alias("amount"),
        "interest_date",
        F.when(key % 11 == 0, F.date_add(FROM_DATE, 1)).otherwise(F.col(FROM_DATE)).alias(FROM_DATE),
        F.when(key % 13 == 0, date_lit("2002-06-30")).otherwise(F.col(TO_DATE)).alias(TO_DATE),
    )
    new_key = 1_000_000_000 + F.col("s_suppkey")
    new = table(spark, sf_dir, "supplier").select(
        new_key.alias("contract_id"),
        (100 + F.col("s_nationkey") % 7).cast("bigint").alias("territory_id"),
        F.concat(F.lit("EXT"), new_key).alias("external_contract_id"),
        F.round("s_acctbal", 2).cast("decimal(12,2)").alias("amount"),
        date_lit("2001-12-01").alias("interest_date"),
        date_lit("2001-12-01").alias(FROM_DATE),
        date_lit(OPEN_END).alias(TO_DATE),
    )
    return known.unionByName(new)


def day2_fragments(spark: SparkSession, sf_dir: str, history: DataFrame | None = None) -> DataFrame:
    """The same feed with every range cut into two that abut."""
    cut = F.date_add(FROM_DATE, 10)
    halves = F.array(
        F.struct(F.col(FROM_DATE).alias("f"), cut.alias("t")),
        F.struct(F.date_add(cut, 1).alias("f"), F.col(TO_DATE).alias("t")),
    )
    attributes = [c for c in CONTRACT_COLUMNS if c not in (FROM_DATE, TO_DATE)]
    return day2(spark, sf_dir, history).select(*attributes, F.inline(halves).alias(FROM_DATE, TO_DATE))


def stored_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean history as a table of its own, as a warehouse would hold it."""
    return durable(timeline(spark, sf_dir), "timeline")


def first_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_ids(timeline(spark, sf_dir))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version table after the first load of the clean history."""
    staged = stored_timeline(spark, sf_dir)
    return initial_load(staged, assign_ids(staged))


def _list_of(prefix: str, length: Column) -> Column:
    """Texts prefix0 … prefix(length-1)."""
    numbers = F.when(length > 0, F.sequence(F.lit(0).cast("bigint"), length - 1)).otherwise(
        F.array().cast("array<bigint>"))
    return F.transform(numbers, lambda i: F.concat(F.lit(prefix), i))


def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per customer, with absent members and empty arrays."""
    key = F.col("c_custkey")
    product = F.struct(
        F.concat(F.lit("P"), key).alias("name"),
        F.struct(
            F.concat(F.lit("B"), key % 10).alias("brand"),
            F.struct(F.concat(key % 64, F.lit("GB")).alias("ram"),
                     F.concat(key % 1024, F.lit("GB")).alias("storage")).alias("specs"),
        ).alias("details"),
    )
    document = F.struct(
        F.when(key % 7 != 0, F.col("c_name")).alias("name"),
        F.struct(F.concat(F.lit("C"), F.col("c_nationkey")).alias("city"),
                 F.lpad(key.cast("string"), 5, "0").alias("zip")).alias("address"),
        _list_of("contact-", key % 4).alias("contacts"),
        _list_of("skill-", key % 3).alias("skills"),
        F.when(key % 5 != 0, product).alias("product"),
        F.when(key % 3 != 0, _list_of("hobby-", key % 3)).alias("hobbies"),
    )
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("record_id"),
        (ts_lit(RECORD_EPOCH, "timestamp_ntz") + F.make_dt_interval(mins=key.cast("int"))).alias("updated_at"),
        F.to_json(document).alias("json_field"),
    )


def json_records_resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents plus a later copy, an hour on, of each one without a product."""
    records = json_records(spark, sf_dir)
    again = records.filter(F.get_json_object("json_field", "$.product").isNull()).withColumn(
        "updated_at", F.col("updated_at") + F.make_dt_interval(hours=F.lit(1)))
    return records.unionByName(again)
