"""The date and key macros as temporary SQL functions, so that SQL texts can use them by name.

Each is a SQL expression, so Catalyst puts it in the place of the call: constants fold, filters on it are pushed down and no
Python runs. They are those of ``functions.dates`` and ``functions.keys`` and give the same values.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from spanledger.functions.keys import KEY_NULL_MARKER, KEY_SEPARATOR
from spanledger.schemas import FROM_DATE, OPEN_END, TO_DATE


def _key_text(*columns: str) -> str:
    return ", ".join(f"coalesce(cast({c} as string), '{KEY_NULL_MARKER}')" for c in columns)


#: name, parameters, what it returns, expression
SCALARS = (
    ("lag_period", "run_date DATE", "STRING", "date_format(date_sub(run_date, 1), 'yyyyMM')"),
    ("get_dates", "kind STRING, run_date DATE", "STRING",
     "CASE kind WHEN 'today' THEN cast(run_date AS STRING) WHEN 'yesterday' THEN cast(date_sub(run_date, 1) AS STRING) "
     "WHEN 'lag_period' THEN date_format(date_sub(run_date, 1), 'yyyyMM') "
     "ELSE raise_error(concat('kind must be today, yesterday or lag_period, not ', coalesce(kind, 'NULL'))) END"),
    ("first_working_day", "d DATE", "DATE",
     "date_add(trunc(d, 'month'), CASE WHEN weekday(trunc(d, 'month')) < 5 THEN 0 ELSE 7 - weekday(trunc(d, 'month')) END)"),
    ("contract_hash", "contract_id BIGINT, territory_id BIGINT", "BIGINT",
     f"cast(conv(substring(md5(concat(cast(contract_id AS STRING), '{KEY_SEPARATOR}', cast(territory_id AS STRING))), 1, 15), 16, 10) AS BIGINT)"),
    ("contract_key", "contract_id BIGINT, territory_id BIGINT, from_date DATE", "STRING",
     f"md5(concat_ws('{KEY_SEPARATOR}', {_key_text('contract_id', 'territory_id', 'from_date')}))"),
    ("is_open", "to_date DATE", "BOOLEAN", f"coalesce(to_date = DATE'{OPEN_END}', false)"),
)

#: name, parameters, columns, query; they read the view that is named ``history`` when they are registered
TABLES = (
    ("contracts_on", "on_day DATE", "contract_id BIGINT, territory_id BIGINT, amount DECIMAL(12,2)",
     f"SELECT contract_id, territory_id, amount FROM {{history}} WHERE on_day BETWEEN {FROM_DATE} AND {TO_DATE}"),
    ("contract_versions_of", "wanted_contract BIGINT, wanted_territory BIGINT", f"amount DECIMAL(12,2), {FROM_DATE} DATE, {TO_DATE} DATE",
     f"SELECT amount, {FROM_DATE}, {TO_DATE} FROM {{history}} WHERE contract_id = wanted_contract AND territory_id = wanted_territory"),
)


def register_macros(spark: SparkSession, history: str | None = None) -> list[str]:
    """Create the functions in this session; returns their names. ``history`` is the view that the table functions read."""
    names = []
    for name, parameters, returns, body in SCALARS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {returns} RETURN {body}")
        names.append(name)
    for name, parameters, columns, body in TABLES if history else ():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({columns}) RETURN {body.format(history=history)}")
        names.append(name)
    return names
