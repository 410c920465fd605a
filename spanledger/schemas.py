"""Typed schemas of the contract warehouse, and the open-end sentinel."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values -----------------------------------------------------------------
OPEN_END = "9999-12-31"
CONTRACT_KEY = ["contract_id", "territory_id"]
CONTRACT_ATTRIBUTES = ["external_contract_id", "amount", "interest_date"]
IDENTIFIER = "contract_identifier"
FROM_DATE = "effective_from_date"
TO_DATE = "effective_to_date"
# ------------------------------------------------------------------------------

GROUPING_COLUMNS = CONTRACT_KEY + CONTRACT_ATTRIBUTES
CONTRACT_COLUMNS = GROUPING_COLUMNS + [FROM_DATE, TO_DATE]
FINAL_COLUMNS = [IDENTIFIER] + CONTRACT_COLUMNS
DIM_COLUMNS = ["contract_sk"] + FINAL_COLUMNS + ["is_current"]


def _required(name: str, data_type: T.DataType) -> T.StructField:
    return T.StructField(name, data_type, nullable=False)


def _optional(name: str, data_type: T.DataType) -> T.StructField:
    return T.StructField(name, data_type, nullable=True)


STAGED_CONTRACTS = T.StructType([
    _required("contract_id", T.LongType()),
    _required("territory_id", T.LongType()),
    _required("external_contract_id", T.StringType()),
    _required("amount", T.DecimalType(10, 2)),
    _required("interest_date", T.DateType()),
    _required(FROM_DATE, T.DateType()),
    _required(TO_DATE, T.DateType()),
])

IDENTIFIER_MAP = T.StructType([
    _required("contract_id", T.LongType()),
    _required("territory_id", T.LongType()),
    _required(IDENTIFIER, T.LongType()),
])

CONTRACTS_FINAL = T.StructType([_required(IDENTIFIER, T.LongType()), *STAGED_CONTRACTS.fields])

TERRITORY_REFERENCE = T.StructType([
    _required("territory_id", T.LongType()),
    _optional("territory_name", T.StringType()),
    _optional("region", T.StringType()),
    _optional("country", T.StringType()),
])

# One control layout serves all load styles: ``target_table`` is NULL for
# single-target loads, ``watermark`` is the newest change timestamp read.
CONTROL_LOG = T.StructType([
    _optional("target_table", T.StringType()),
    _required("batch_id", T.StringType()),
    _optional("start_time", T.TimestampType()),
    _optional("end_time", T.TimestampType()),
    _required("status", T.StringType()),
    _optional("processed_record_count", T.LongType()),
    _optional("error_message", T.StringType()),
    _optional("watermark", T.TimestampType()),
])

FLATTENED_RECORDS = T.StructType([
    _optional("record_id", T.StringType()),
    _optional("updated_at", T.TimestampType()),
    _optional("name", T.StringType()),
    _optional("address_city", T.StringType()),
    _optional("address_zip", T.StringType()),
    _optional("contact", T.StringType()),
    _optional("contact_index", T.LongType()),
    _optional("skill", T.StringType()),
    _optional("skill_index", T.LongType()),
    _optional("product_name", T.StringType()),
    _optional("product_details_brand", T.StringType()),
    _optional("product_details_specs_ram", T.StringType()),
    _optional("product_details_specs_storage", T.StringType()),
    _optional("hobby", T.StringType()),
    _optional("hobby_index", T.LongType()),
    _optional("partition_date", T.DateType()),
    _optional("batch_id", T.StringType()),
    _optional("processed_at", T.TimestampType()),
])
