"""SQL twins of the registered queries, written separately from the operators.

They state each result directly (self-joins, EXISTS, window functions) instead of
following how the Spark side computes it.
"""

from __future__ import annotations

# --- shared relations -----------------------------------------------------------

CONTRACTS = """
contracts AS (
  SELECT o_custkey AS contract_id, 100 + o_custkey % 7 AS territory_id,
         'EXT' || o_custkey || '-' || substr(o_orderpriority, 1, 1) AS external_contract_id,
         CAST(round(c_acctbal, 2) AS DECIMAL(12,2)) AS amount, DATE '2001-12-31' AS interest_date,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS effective_from_date,
         CASE WHEN o_orderkey % 11 = 0 THEN DATE '9999-12-31'
              ELSE last_day(CAST(date_trunc('month', o_orderdate) + to_months(CAST(o_orderkey % 12 AS INTEGER)) AS DATE))
         END AS effective_to_date
  FROM orders, customer WHERE o_custkey = c_custkey)"""

TIMELINE = """
days AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, max(o_totalprice) AS price FROM orders GROUP BY ALL),
timeline AS (
  SELECT o_custkey AS contract_id, 100 + o_custkey % 7 AS territory_id, 'EXT' || o_custkey AS external_contract_id,
         CAST(price AS DECIMAL(12,2)) AS amount, d AS interest_date, d AS effective_from_date,
         coalesce((SELECT min(n.d) FROM days n WHERE n.o_custkey = days.o_custkey AND n.d > days.d) - 1,
                  DATE '9999-12-31') AS effective_to_date
  FROM days)"""

DAY2 = TIMELINE + """,
day2 AS (
  SELECT t.contract_id, t.territory_id, t.external_contract_id,
         CAST(t.amount + CASE WHEN t.contract_id % 5 = 0 THEN 50 ELSE 0 END AS DECIMAL(12,2)) AS amount,
         t.interest_date,
         t.effective_from_date + CASE WHEN t.contract_id % 11 = 0 THEN 1 ELSE 0 END AS effective_from_date,
         CASE WHEN t.contract_id % 13 = 0 THEN DATE '2002-06-30' ELSE t.effective_to_date END AS effective_to_date
  FROM timeline t, customer c
  WHERE t.contract_id = c.c_custkey AND t.effective_to_date = DATE '9999-12-31' AND c.c_mktsegment <> 'FURNITURE'
  UNION ALL
  SELECT 1000000000 + s_suppkey, 100 + s_nationkey % 7, 'EXT' || (1000000000 + s_suppkey),
         CAST(round(s_acctbal, 2) AS DECIMAL(12,2)), DATE '2001-12-01', DATE '2001-12-01', DATE '9999-12-31'
  FROM supplier)"""

FIRST_IDS = """,
ids AS (
  SELECT contract_id, territory_id, row_number() OVER (ORDER BY contract_id, territory_id) AS contract_identifier
  FROM (SELECT DISTINCT contract_id, territory_id FROM timeline))"""

HISTORY = TIMELINE + FIRST_IDS + """,
history AS (SELECT contract_identifier, t.* FROM timeline t JOIN ids USING (contract_id, territory_id))"""

NEXT_IDS = """,
ids2 AS (
  SELECT * FROM ids
  UNION ALL
  SELECT contract_id, territory_id,
         (SELECT max(contract_identifier) FROM ids) + row_number() OVER (ORDER BY contract_id, territory_id)
  FROM (SELECT contract_id, territory_id FROM day2 EXCEPT SELECT contract_id, territory_id FROM timeline))"""

BOTH_DAYS = DAY2 + FIRST_IDS + NEXT_IDS + """,
history AS (SELECT contract_identifier, t.* FROM timeline t JOIN ids USING (contract_id, territory_id)),
feed AS (SELECT contract_identifier, d.* FROM day2 d JOIN ids2 USING (contract_id, territory_id))"""

RECORDS = """
records AS (
  SELECT CAST(c_custkey AS VARCHAR) AS record_id,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(c_custkey) AS updated_at,
         CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS name,
         'C' || c_nationkey AS address_city,
         CASE WHEN c_custkey > 99999 THEN substr(CAST(c_custkey AS VARCHAR), 1, 5)
              ELSE lpad(CAST(c_custkey AS VARCHAR), 5, '0') END AS address_zip,
         CASE WHEN c_custkey % 5 <> 0 THEN 'P' || c_custkey END AS product_name,
         CASE WHEN c_custkey % 5 <> 0 THEN 'B' || (c_custkey % 10) END AS product_details_brand,
         CASE WHEN c_custkey % 5 <> 0 THEN (c_custkey % 64) || 'GB' END AS product_details_specs_ram,
         CASE WHEN c_custkey % 5 <> 0 THEN (c_custkey % 1024) || 'GB' END AS product_details_specs_storage,
         c_custkey % 4 AS n_contacts, c_custkey % 3 AS n_skills, c_custkey % 3 AS n_hobbies
  FROM customer)"""

# An outer unnest is a join with the indexes below the length, or one NULL index.
FLAT = """
SELECT record_id, updated_at, name, address_city, address_zip, product_name, product_details_brand,
       product_details_specs_ram, product_details_specs_storage,
       'contact-' || ci.i AS contact, ci.i AS contact_index, 'skill-' || si.i AS skill, si.i AS skill_index,
       'hobby-' || hi.i AS hobby, hi.i AS hobby_index, CAST(updated_at AS DATE) AS partition_date
FROM {records} r
LEFT JOIN range(0, 4) ci(i) ON ci.i < n_contacts
LEFT JOIN range(0, 3) si(i) ON si.i < n_skills
LEFT JOIN range(0, 3) hi(i) ON hi.i < n_hobbies"""


def shaped(ctes: str, body: str, text: str = "", double: str = "", bigint: str = "") -> str:
    """The body with dates as text, decimals as doubles and wide sums as bigint."""
    casts = [f"CAST({c} AS {t}) AS {c}"
             for names, t in ((text, "VARCHAR"), (double, "DOUBLE"), (bigint, "BIGINT")) for c in names.split()]
    columns = f"* REPLACE ({', '.join(casts)})" if casts else "*"
    with_clause = f"WITH {ctes.strip()} " if ctes else ""
    return f"{with_clause}SELECT {columns} FROM ({body.strip()})"


RANGE = "effective_from_date effective_to_date"
DATES = f"interest_date {RANGE}"
INDEXES = "contact_index skill_index hobby_index"
SAME_GROUP = ("o.contract_id = c.contract_id AND o.external_contract_id = c.external_contract_id "
              "AND o.territory_id = c.territory_id AND o.amount = c.amount AND o.interest_date = c.interest_date")
GROUPING = "contract_id, territory_id, external_contract_id, amount, interest_date"

CONSOLIDATED = CONTRACTS + f""",
judged AS (
  SELECT c.*,
         c.effective_to_date = DATE '9999-12-31'
         OR EXISTS (SELECT 1 FROM contracts o WHERE {SAME_GROUP}
                    AND o.effective_from_date = c.effective_to_date + 1)
         OR NOT EXISTS (SELECT 1 FROM contracts o WHERE {SAME_GROUP}
                        AND o.effective_from_date > c.effective_to_date) AS fine
  FROM contracts c),
grouped AS (
  SELECT {GROUPING}, bool_and(fine) AS whole, count(*) AS n,
         min(effective_from_date) AS f, max(effective_to_date) AS t FROM judged GROUP BY ALL),
consolidated AS (
  SELECT {GROUPING}, f AS effective_from_date, t AS effective_to_date, true AS was_consolidated,
         n AS original_record_count
  FROM grouped WHERE whole
  UNION ALL
  SELECT {GROUPING}, c.effective_from_date, c.effective_to_date, false, n
  FROM contracts c JOIN grouped USING ({GROUPING}) WHERE NOT whole)"""

ISLANDS = CONTRACTS + f""",
w AS (
  SELECT *, max(effective_to_date) OVER (PARTITION BY {GROUPING} ORDER BY effective_from_date, effective_to_date
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM contracts),
marked AS (
  SELECT *, sum(CASE WHEN reach IS NULL OR datediff('day', reach, effective_from_date) > 1 THEN 1 ELSE 0 END)
            OVER (PARTITION BY {GROUPING} ORDER BY effective_from_date, effective_to_date ROWS UNBOUNDED PRECEDING) AS g
  FROM w)"""


def scd2(differs: str, per_identifier: bool, version_open_only: bool, version_to: str) -> str:
    """History after day 2; ``differs`` compares history row p with feed row s."""
    changed = f"EXISTS (SELECT 1 FROM feed s WHERE s.contract_identifier = p.contract_identifier AND ({differs}))"
    any_changed = ("EXISTS (SELECT 1 FROM history p WHERE p.contract_identifier = s.contract_identifier "
                   f"AND p.effective_to_date = DATE '9999-12-31' AND ({differs}))")
    if per_identifier:
        changed = (f"p.contract_identifier IN (SELECT p2.contract_identifier FROM history p2 JOIN feed s "
                   f"ON s.contract_identifier = p2.contract_identifier WHERE "
                   f"p2.effective_to_date = DATE '9999-12-31' AND ({differs.replace('p.', 'p2.')}))")
    version_filter = "AND s.effective_to_date = DATE '9999-12-31'" if version_open_only else ""
    return f"""
SELECT p.contract_identifier, p.contract_id, p.territory_id, p.external_contract_id, p.amount, p.interest_date,
       p.effective_from_date, p.effective_from_date AS staged_from,
       CASE WHEN p.effective_to_date = DATE '9999-12-31' AND {changed} THEN DATE '2001-12-30'
            ELSE p.effective_to_date END AS effective_to_date
FROM history p
UNION ALL
SELECT s.contract_identifier, s.contract_id, s.territory_id, s.external_contract_id, s.amount, s.interest_date,
       DATE '2001-12-31', s.effective_from_date, {version_to}
FROM feed s WHERE {any_changed} {version_filter}
UNION ALL
SELECT s.contract_identifier, s.contract_id, s.territory_id, s.external_contract_id, s.amount, s.interest_date,
       s.effective_from_date, s.effective_from_date, s.effective_to_date
FROM feed s WHERE s.contract_identifier NOT IN (SELECT contract_identifier FROM history)"""


ATTRIBUTES_DIFFER = ("s.external_contract_id <> p.external_contract_id OR s.amount <> p.amount "
                     "OR s.interest_date <> p.interest_date")
MERGE_DIFFERS = ATTRIBUTES_DIFFER + " OR s.effective_from_date <> p.effective_from_date"
SQLITE_DIFFERS = MERGE_DIFFERS + " OR s.effective_to_date <> p.effective_to_date"
DBT_ROWS = scd2(ATTRIBUTES_DIFFER, False, True, "s.effective_to_date")

# Feed rows whose two halves abut merge back; a half-range whose end was cut short
# before its own start never happens, so the consolidated feed equals day2.
FINAL_COLUMNS = ("contract_identifier, contract_id, territory_id, external_contract_id, amount, interest_date, "
                 "effective_from_date, effective_to_date")


def _final(rows: str) -> str:
    return f"SELECT {FINAL_COLUMNS} FROM ({rows})"


def _dim(key_date: str) -> str:
    return f"""
SELECT md5(contract_id || '-' || territory_id || '-' || CAST({key_date} AS VARCHAR)) AS contract_sk, {FINAL_COLUMNS},
       effective_to_date = DATE '9999-12-31' AS is_current
FROM ({DBT_ROWS})"""


SPINE = """
span AS (SELECT date_trunc('month', min(CAST(o_orderdate AS DATE)))::TIMESTAMP AS s,
                last_day(CAST(max(CAST(o_orderdate AS DATE)) + INTERVAL 3 MONTH AS DATE))::TIMESTAMP AS e FROM orders),
months AS (SELECT CAST(unnest(range(s, e, INTERVAL 1 MONTH)) AS DATE) AS effective_date FROM span)"""
# The territory reference seed.
TERRITORIES = """
territories(territory_id, territory_name, region, country) AS (VALUES
  (100, 'Northeast', 'East', 'USA'), (101, 'Southeast', 'East', 'USA'), (102, 'Midwest', 'Central', 'USA'),
  (103, 'Southwest', 'West', 'USA'), (104, 'West', 'West', 'USA'), (105, 'Canada East', 'North', 'Canada'),
  (106, 'Canada West', 'North', 'Canada'))"""

ORACLES: dict[str, str] = {}

# --- consolidation and identifiers ------------------------------------------------

ORACLES["consolidate_all_or_nothing"] = shaped(CONSOLIDATED, "SELECT * FROM consolidated", DATES, "amount")
ORACLES["consolidate_by_marks"] = ORACLES["consolidate_all_or_nothing"]
ORACLES["consolidate_mixed_groups"] = ORACLES["consolidate_all_or_nothing"]
ORACLES["consolidate_islands"] = shaped(ISLANDS, f"""
SELECT {GROUPING}, min(effective_from_date) AS effective_from_date, max(effective_to_date) AS effective_to_date,
       count(*) > 1 AS was_consolidated, count(*) AS original_record_count
FROM marked GROUP BY {GROUPING}, g""", DATES, "amount")
ORACLES["consolidation_impact"] = shaped(CONSOLIDATED, """
SELECT b.n AS before_record_count, a.n AS after_record_count, b.n - a.n AS records_reduced,
       round(100.0 * (b.n - a.n) / b.n, 2) AS percent_reduction, a.merged AS consolidated_contract_count,
       b.u AS before_unique_contracts, a.u AS after_unique_contracts
FROM (SELECT count(*) AS n, count(DISTINCT contract_id || '-' || territory_id) AS u FROM contracts) b,
     (SELECT count(*) AS n, count(DISTINCT contract_id || '-' || territory_id) AS u,
             count(*) FILTER (was_consolidated) AS merged FROM consolidated) a""", double="percent_reduction")
ORACLES["stage_contracts"] = shaped(
    CONTRACTS, "SELECT *, TIMESTAMP '2001-12-31 06:00:00' AS loaded_at FROM contracts", f"{DATES} loaded_at", "amount")
ORACLES["assign_ids_initial"] = shaped(CONTRACTS, """
SELECT contract_id, territory_id, dense_rank() OVER (ORDER BY contract_id, territory_id) AS contract_identifier
FROM contracts GROUP BY contract_id, territory_id""")
ORACLES["assign_ids_incremental"] = shaped(DAY2 + FIRST_IDS + NEXT_IDS, "SELECT * FROM ids2")
ORACLES["identifier_listing"] = shaped(TIMELINE + FIRST_IDS, "SELECT * FROM ids")
ORACLES["contract_keys"] = shaped(CONTRACTS, """
SELECT *, md5(contract_id || '-' || territory_id || '-' || strftime(effective_from_date, '%Y-%m-%d')) AS contract_sk,
       ('0x' || substr(md5(contract_id || '-' || territory_id), 1, 15))::BIGINT AS contract_hash
FROM contracts""", DATES, "amount")

# --- version history ----------------------------------------------------------------

ORACLES["scd2_initial_load"] = shaped(HISTORY, "SELECT * FROM history", DATES, "amount")
ORACLES["scd2_sqlite"] = shaped(
    BOTH_DAYS, _final(scd2(SQLITE_DIFFERS, True, False, "DATE '9999-12-31'")), DATES, "amount")
ORACLES["scd2_ranged"] = shaped(BOTH_DAYS, _final(DBT_ROWS), DATES, "amount")
ORACLES["scd2_ranged_index"] = shaped(HISTORY, """
SELECT contract_identifier // 50 AS key_range, min(contract_identifier) AS low, max(contract_identifier) AS high,
       count(*) + count(*) FILTER (effective_to_date = DATE '9999-12-31' AND contract_id % 100 = 7) AS n_rows,
       max(CASE WHEN effective_to_date = DATE '9999-12-31' AND contract_id % 100 = 7 THEN 1 ELSE 0 END)::BIGINT AS step
FROM history GROUP BY ALL""")
ORACLES["upsert_ranged"] = shaped(HISTORY, """
SELECT * REPLACE (CAST(amount + CASE WHEN effective_to_date = DATE '9999-12-31' AND contract_id % 100 < 3 THEN 5 ELSE 0 END
                       AS DECIMAL(12,2)) AS amount)
FROM history""", DATES, "amount")
ORACLES["scd2_merge"] = shaped(
    BOTH_DAYS, _final(scd2(MERGE_DIFFERS, False, False, "DATE '9999-12-31'")), DATES, "amount")
ORACLES["scd2_dbt_v1"] = shaped(BOTH_DAYS, _final(DBT_ROWS), DATES, "amount")
ORACLES["scd2_dbt_final"] = ORACLES["scd2_dbt_v1"]
ORACLES["scd2_final_parity"] = shaped(
    BOTH_DAYS, _final(scd2(ATTRIBUTES_DIFFER, False, False, "s.effective_to_date")), DATES, "amount")
ORACLES["scd2_gapped_feed"] = shaped(HISTORY, """
SELECT * FROM history WHERE effective_to_date = DATE '9999-12-31' OR day(effective_from_date) % 5 <> 0""", DATES, "amount")
ORACLES["dim_contracts"] = shaped(BOTH_DAYS, _dim("effective_from_date"), DATES, "amount")
ORACLES["dim_contracts_other_open_end"] = shaped(BOTH_DAYS, f"""
SELECT * REPLACE (CASE WHEN is_current THEN DATE '2999-12-31' ELSE effective_to_date END AS effective_to_date)
FROM ({_dim("effective_from_date")})""", DATES, "amount")
ORACLES["dim_contracts_staged_key"] = shaped(BOTH_DAYS, _dim("staged_from"), DATES, "amount")
ORACLES["upsert_by_key"] = shaped(DAY2, """
SELECT *, md5(contract_id || '-' || territory_id || '-' || CAST(effective_from_date AS VARCHAR)) AS contract_sk
FROM (SELECT t.* FROM timeline t WHERE NOT EXISTS (
        SELECT 1 FROM day2 d WHERE d.contract_id = t.contract_id AND d.effective_from_date = t.effective_from_date)
      UNION ALL SELECT * FROM day2)""", DATES, "amount")
ORACLES["upsert_schema_sync"] = shaped(DAY2, """
SELECT contract_id, territory_id, external_contract_id, amount, effective_from_date, effective_to_date,
       DATE '2001-12-31' AS load_date FROM day2
UNION ALL
SELECT contract_id, territory_id, external_contract_id, amount, effective_from_date, effective_to_date, NULL
FROM timeline t WHERE NOT EXISTS (
  SELECT 1 FROM day2 d WHERE d.contract_id = t.contract_id AND d.effective_from_date = t.effective_from_date)
""", f"{RANGE} load_date", "amount")
ORACLES["semi_join_update"] = shaped(TIMELINE, """
SELECT * REPLACE (CASE WHEN effective_to_date = DATE '9999-12-31'
                            AND contract_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 1000)
                       THEN DATE '2001-12-30' ELSE effective_to_date END AS effective_to_date)
FROM timeline""", DATES, "amount")

# --- reports and marts ----------------------------------------------------------------

ACTIVE = "effective_to_date = DATE '9999-12-31'"
ORACLES["active_contracts"] = shaped(HISTORY, f"SELECT * FROM history WHERE {ACTIVE}", DATES, "amount")
ORACLES["contract_history_one"] = shaped(
    HISTORY, "SELECT * FROM history WHERE contract_id = 1 AND territory_id = 101", DATES, "amount")
ORACLES["contract_versions"] = shaped(HISTORY, """
SELECT contract_identifier, contract_id, territory_id, amount, effective_from_date, effective_to_date FROM history
""", RANGE, "amount")
ORACLES["territory_contract_count"] = shaped(HISTORY, f"""
SELECT territory_id, count(DISTINCT contract_identifier) AS contract_count
FROM history WHERE {ACTIVE} GROUP BY territory_id""")
ORACLES["territory_amount"] = shaped(HISTORY, f"""
SELECT territory_id, sum(amount) AS total_amount, format('${{:,.2f}}', CAST(sum(amount) AS DOUBLE)) AS formatted_amount
FROM history WHERE {ACTIVE} GROUP BY territory_id""", double="total_amount")
ORACLES["amount_change_history"] = shaped(HISTORY, """
SELECT h.contract_identifier, h.contract_id, h.territory_id, h.amount, b.amount AS previous_amount,
       CASE WHEN b.amount IS NULL THEN 'New Record' WHEN b.amount <> h.amount THEN 'Amount Changed'
            ELSE 'Other Change' END AS change_type,
       h.effective_from_date, h.effective_to_date
FROM history h LEFT JOIN history b
  ON b.contract_identifier = h.contract_identifier AND b.effective_to_date = h.effective_from_date - 1
""", RANGE, "amount previous_amount")
ORACLES["change_history_hot"] = ORACLES["amount_change_history"]
ORACLES["date_spine"] = shaped("", """
SELECT CAST(m AS DATE) AS effective_date, CAST(m AS DATE) AS effective_month, last_day(CAST(m AS DATE)) AS month_end_date
FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                    CAST(max(o_orderdate) AS DATE) + INTERVAL 3 MONTH - INTERVAL 1 DAY,
                                    INTERVAL 1 MONTH)) AS m FROM orders)""",
                               "effective_date effective_month month_end_date")
ORACLES["fct_contract_metrics"] = shaped(HISTORY + "," + SPINE + "," + TERRITORIES, """
SELECT date_trunc('month', effective_date)::DATE AS effective_month, effective_date, h.territory_id, territory_name,
       region, country, count(DISTINCT contract_identifier) AS contract_count, sum(amount) AS total_amount,
       CAST(CAST(sum(amount) * 100 AS HUGEINT) * 10000 // count(amount) AS DOUBLE) / 1e6 AS avg_amount, min(amount) AS min_amount, max(amount) AS max_amount
FROM months JOIN history h ON effective_date BETWEEN effective_from_date AND effective_to_date
LEFT JOIN territories t ON t.territory_id = h.territory_id
GROUP BY ALL""", "effective_month effective_date", "total_amount min_amount max_amount")
ORACLES["contracts_by_month"] = shaped(HISTORY + "," + SPINE, """
SELECT date_trunc('month', effective_date)::DATE AS effective_month, effective_date, contract_identifier, contract_id,
       territory_id, external_contract_id, amount, interest_date
FROM months JOIN history ON effective_date BETWEEN effective_from_date AND effective_to_date""",
                                       "effective_month effective_date interest_date", "amount")
ORACLES["csv_seed"] = shaped(HISTORY + "," + TERRITORIES, f"""
SELECT h.territory_id, territory_name, region, country, count(DISTINCT contract_identifier) AS contract_count
FROM history h LEFT JOIN territories t ON t.territory_id = h.territory_id WHERE {ACTIVE} GROUP BY ALL""")

# --- incremental extraction and JSON ----------------------------------------------------

ORACLES["incremental_extract"] = shaped(RECORDS, """
SELECT record_id, updated_at FROM records WHERE updated_at > TIMESTAMP '2024-01-01 06:00:00'""", "updated_at")
ORACLES["incremental_extract_targets"] = shaped(RECORDS, """
SELECT record_id, updated_at, target_table
FROM records JOIN (VALUES ('table1', TIMESTAMP '2024-01-01 03:30:00'), ('table2', TIMESTAMP '2024-01-01 06:00:00'),
                          ('table3', TIMESTAMP '2023-01-02 00:00:00')) m(target_table, mark) ON updated_at > mark
""", "updated_at")
ORACLES["batches_with_gaps"] = shaped(RECORDS, """
SELECT CAST(record_id AS VARCHAR) AS record_id, updated_at, 'records' AS origin FROM records
UNION ALL SELECT * FROM (VALUES ('b1', NULL, 'completed false'), ('b2', NULL, 'completed true'), ('b3', NULL, 'failed false'),
                                ('b4', NULL, 'completed false'))""", "updated_at")
HALF = "CAST(record_id AS BIGINT) <= (SELECT max(CAST(record_id AS BIGINT)) // 2 FROM records)"
ORACLES["load_records"] = shaped(RECORDS + f""",
copies AS (
  SELECT record_id, updated_at FROM records
  UNION ALL SELECT record_id, updated_at + INTERVAL 1 HOUR FROM records WHERE product_name IS NULL),
loaded AS (
  SELECT record_id, updated_at, 'b1' AS batch_id FROM records WHERE {HALF}
  UNION ALL
  SELECT record_id, max(updated_at), 'b3' FROM copies
  WHERE updated_at > (SELECT max(updated_at) FROM records WHERE {HALF}) GROUP BY record_id)""", """
SELECT l.record_id, l.updated_at, batch_id,
       CAST(greatest(n_contacts, 1) * greatest(n_skills, 1) * greatest(n_hobbies, 1) AS BIGINT) AS n_rows
FROM loaded l JOIN records r USING (record_id)""", "updated_at")
ORACLES["load_exactly_once"] = f"SELECT *, 3::BIGINT AS n_batches_written FROM ({ORACLES['load_records']})"
ORACLES["load_routed"] = shaped(RECORDS + f""",
sent AS (
  SELECT 'table1' AS target_table, record_id, updated_at FROM records WHERE name IS NOT NULL
  UNION ALL SELECT 'table2', record_id, updated_at FROM records WHERE product_name IS NOT NULL),
first AS (SELECT target_table, max(updated_at) AS mark FROM sent WHERE {HALF} GROUP BY target_table),
loaded AS (
  SELECT target_table, updated_at, 'b1' AS batch_id FROM sent WHERE {HALF}
  UNION ALL SELECT target_table, updated_at, 'b3' FROM sent JOIN first USING (target_table) WHERE updated_at > mark)""", """
SELECT target_table, batch_id, 'completed' AS status, max(updated_at) AS watermark, count(*) AS n_logged, count(*) AS n_stored
FROM loaded GROUP BY target_table, batch_id
UNION ALL SELECT * FROM (VALUES ('table1', 'b2', 'failed', NULL, -1, -1), ('table2', 'b2', 'failed', NULL, -1, -1))
""", "watermark")
ORACLES["constant_left_join"] = shaped(RECORDS, """
SELECT record_id, updated_at, mark AS last_extraction_time, target_table
FROM records, (VALUES ('table1', TIMESTAMP '2024-01-01 04:00:00'), ('table3', NULL)) m(target_table, mark)
""", "updated_at last_extraction_time")
ORACLES["dedup_latest"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events l WHERE l.user_id = e.user_id
                  AND (l.ts > e.ts OR (l.ts = e.ts AND l.event_id > e.event_id)))"""
ORACLES["event_properties"] = """
SELECT event_id, event_type, CAST(regexp_extract(props, '"k": (\\d+)', 1) AS BIGINT) AS k FROM events"""
ORACLES["flatten_json"] = shaped(
    RECORDS, f"SELECT *, 'b1' AS batch_id, TIMESTAMP '2024-01-02 00:00:00' AS processed_at FROM ({FLAT.format(records='records')})",
    f"updated_at partition_date processed_at {INDEXES}")
ORACLES["conform_records"] = ORACLES["flatten_json"]
ORACLES["flatten_json_deduplicated"] = shaped(RECORDS + """,
newest AS (
  SELECT * REPLACE (updated_at + CASE WHEN product_name IS NULL THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END
                    AS updated_at)
  FROM records),
changed AS (SELECT * FROM newest WHERE updated_at > TIMESTAMP '2024-01-01 06:00:00')""",
    FLAT.format(records="changed"), f"updated_at partition_date {INDEXES}")
QUOTED = ["name", "address_city", "address_zip", "product_name", "product_details_brand", "product_details_specs_ram",
          "product_details_specs_storage", "contact", "skill", "hobby"]
ORACLES["flatten_quoted"] = shaped(RECORDS, "SELECT * REPLACE (" + ", ".join(
    f"'\"' || {c} || '\"' AS {c}" for c in QUOTED) + f") FROM ({FLAT.format(records='records')})",
    f"updated_at partition_date {INDEXES}")
ORACLES["flatten_contacts_apart"] = shaped(RECORDS, """
SELECT record_id, updated_at, 'contact-' || i AS contact, i AS contact_index, CAST(updated_at AS DATE) AS partition_date
FROM records JOIN range(0, 4) n(i) ON i < n_contacts""", "updated_at partition_date contact_index")
TABLE1 = "record_id, updated_at, name, address_city, address_zip"
TABLE2 = ("record_id, updated_at, product_name, product_details_brand, product_details_specs_ram, "
          "product_details_specs_storage")
for _name, _columns, _needs in (("route_table1", TABLE1, "name"), ("route_table2", TABLE2, "product_name")):
    ORACLES[_name] = shaped(RECORDS, f"""
SELECT {_columns}, CAST(updated_at AS DATE) AS partition_date, 'b1' AS batch_id
FROM records WHERE {_needs} IS NOT NULL""", "updated_at partition_date")
ORACLES["route_tagged"] = shaped(RECORDS, f"""
SELECT {TABLE1}, NULL AS product_name, NULL AS product_details_brand, NULL AS product_details_specs_ram,
       NULL AS product_details_specs_storage, 'table1' AS target_table, CAST(updated_at AS DATE) AS partition_date
FROM records WHERE name IS NOT NULL
UNION ALL
SELECT record_id, updated_at, NULL, NULL, NULL, product_name, product_details_brand, product_details_specs_ram,
       product_details_specs_storage, 'table2', CAST(updated_at AS DATE)
FROM records WHERE product_name IS NOT NULL""", "updated_at partition_date")
ORACLES["control_log"] = shaped(RECORDS, f"""
SELECT 'records' AS target_table, 'b1' AS batch_id, TIMESTAMP '2024-02-01 00:00:00' AS start_time,
       TIMESTAMP '2024-02-01 01:00:00' AS end_time, 'completed' AS status, count(*) AS processed_record_count,
       max(updated_at) AS watermark, false AS has_error, CAST(0 AS BIGINT) AS still_to_read
FROM ({FLAT.format(records='records')})
UNION ALL
SELECT 'records', 'b2', TIMESTAMP '2024-02-01 01:30:00', TIMESTAMP '2024-02-01 02:00:00', 'failed', -1, NULL, true, 0
""", "start_time end_time watermark")
ORACLES["stream_flatten"] = shaped(RECORDS, FLAT.format(records="records"), f"updated_at partition_date {INDEXES}")

# --- profiling --------------------------------------------------------------------------


def _profile(table: str, columns: dict[str, str], stats: bool = False) -> str:
    """One SELECT per column, as a profiling loop would run them."""
    parts = []
    for name, data_type in columns.items():
        low = high = "CAST(NULL AS VARCHAR)"
        if data_type != "string" or stats:
            low, high = f"CAST(min({name}) AS VARCHAR)", f"CAST(max({name}) AS VARCHAR)"
        part = (f"SELECT '{name}' AS column_name, '{data_type}' AS data_type, count(*) AS total_count, "
                f"count(DISTINCT {name}) AS distinct_count, count(*) - count({name}) AS null_count, "
                f"{low} AS min_value, {high} AS max_value")
        if stats:
            x = f"TRY_CAST({name} AS DOUBLE)"
            part += f", round(min({x}), 4) AS min_number, round(max({x}), 4) AS max_number"
            part += f", round(avg({x}), 4) AS avg_value, round(stddev_samp({x}), 4) AS stddev_value"
            for alias, q in (("median_value", 0.5), ("q1", 0.25), ("q2", 0.5), ("q3", 0.75)):
                part += f", round(quantile_cont({x}, {q}), 4) AS {alias}"
        parts.append(f"{part} FROM {table}")
    return "\nUNION ALL\n".join(parts)


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINEITEM = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
            **dict.fromkeys(MEASURES, "double"), "l_returnflag": "string", "l_linestatus": "string",
            "l_shipdate": "timestamp_ntz"}
ORACLES["profile_basic"] = _profile("lineitem", LINEITEM)
ORACLES["profile_nulls"] = """
WITH e AS (SELECT event_id, nullif(event_type, 'error') AS event_type,
                  nullif(CAST(floor(value) AS BIGINT), 1) AS whole, CAST(user_id AS VARCHAR) AS user_text FROM events)
""" + _profile("e", {"event_id": "bigint", "event_type": "string", "whole": "bigint", "user_text": "string"})
# A date reads as no number.
ORACLES["data_profiling_summary"] = """
WITH l AS (SELECT * FROM lineitem)
""" + _profile("l", {"l_quantity": "double", "l_discount": "double", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"},
               stats=True)
ORACLES["profile_stats"] = """
WITH l AS (SELECT *, CAST(l_partkey AS VARCHAR) AS part_text FROM lineitem)
""" + _profile("l", {**dict.fromkeys(MEASURES, "double"), "l_linenumber": "int", "l_returnflag": "string",
                     "part_text": "string"}, stats=True)


def _boundaries(columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, " + ", ".join(
            f"round(quantile_cont({c}, {q}), 4) AS b{i}" for i, q in enumerate((0.0, 0.25, 0.5, 0.75, 1.0))) + " FROM lineitem"
        for c in columns)


ORACLES["quartile_boundaries"] = _boundaries(MEASURES)
ORACLES["data_profiling_quartiles"] = _boundaries(["l_quantity", "l_discount"])
ORACLES["iqr_outliers"] = """
WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b FROM events)
SELECT event_id, 'value' AS column_name, round(value, 4) AS value, round(a - 1.5 * (b - a), 4) AS lower_bound,
       round(b + 1.5 * (b - a), 4) AS upper_bound
FROM events, q WHERE value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)"""
ORACLES["quantile_sketch_ranks"] = f"""
SELECT column_name, CAST(probability AS DOUBLE) AS probability, count(*) >= 0 AS within_bound
FROM lineitem, (VALUES {", ".join(f"('{c}')" for c in MEASURES)}) c(column_name),
     (VALUES (0.1), (0.25), (0.5), (0.75), (0.9)) p(probability)
GROUP BY ALL"""
ORACLES["data_profiling_outliers"] = """
WITH u AS (SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS unit_price FROM lineitem),
     q AS (SELECT quantile_cont(unit_price, 0.25) AS a, quantile_cont(unit_price, 0.75) AS b FROM u)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, 'unit_price' AS column_name, unit_price AS value,
       round(a - 1.5 * (b - a), 4) AS lower_bound, round(b + 1.5 * (b - a), 4) AS upper_bound
FROM u, q WHERE unit_price < a - 1.5 * (b - a) OR unit_price > b + 1.5 * (b - a)"""
_DERIVED = [(f"{m}_{k}", f"CASE WHEN l_orderkey % {k + 3} <> 0 THEN {m} * {k + 1} + l_linenumber * {k} * 10 END AS {m}_{k}")
            for k in range(10) for m in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
ORACLES["correlation_wide"] = (
    "WITH derived AS (SELECT " + ", ".join(e for _, e in _DERIVED) + " FROM lineitem), scores AS (SELECT [" + ", ".join(
        f"{{'col1': '{a}', 'col2': '{b}', 'correlation_score': round(corr({a}, {b}), 6)}}"
        for i, (a, _) in enumerate(_DERIVED) for b, _ in _DERIVED[i + 1:]) + "] AS s FROM derived) "
    "SELECT u.col1, u.col2, u.correlation_score FROM (SELECT unnest(s) AS u FROM scores)")
ORACLES["correlation_matrix"] = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS col1, '{b}' AS col2, round(corr({a}, {b}), 6) AS correlation_score FROM lineitem"
    for i, a in enumerate(MEASURES) for b in MEASURES[i + 1:])


def _moment_skew(x: str) -> str:
    return f"avg(pow({x} - m_{x}, 3)) / pow(avg(pow({x} - m_{x}, 2)), 1.5)"


ORACLES["skewness_summary"] = "\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, count(*) AS total_records, round({_moment_skew('x')}, 4) AS skewness,
       round({_moment_skew('y')}, 4) AS log_skewness
FROM (SELECT {c} AS x, ln({c} + 1) AS y FROM lineitem),
     (SELECT avg({c}) AS m_x, avg(ln({c} + 1)) AS m_y FROM lineitem)""" for c in MEASURES)
ORACLES["data_profiling_pairs"] = """
SELECT 'l_quantity' AS col1, 'l_discount' AS col2, round(corr(l_quantity, l_discount), 6) AS correlation_score,
       CAST(NULL AS DOUBLE) AS skewness FROM lineitem""" + "".join(f"""
UNION ALL
SELECT '{c}', '', NULL, round({_moment_skew('x')}, 4)
FROM (SELECT {c} AS x FROM lineitem), (SELECT avg({c}) AS m_x FROM lineitem)""" for c in ("l_quantity", "l_discount"))
ORACLES["log_transform"] = """
SELECT event_id, round(value - 3, 6) AS value,
       round(CASE WHEN value - 3 > -1 THEN ln(value - 3 + 1) END, 6) AS value_log FROM events"""

# --- data quality -------------------------------------------------------------------------


def _verdict(check: str, subject: str, failures: str, severity: str = "error") -> str:
    return (f"SELECT '{check}' AS check_name, '{subject}' AS subject, CAST(({failures}) AS BIGINT) AS failures, "
            f"CASE WHEN ({failures}) = 0 THEN 'pass' ELSE '{severity}' END AS status, '{severity}' AS severity")


def _verdicts(ctes: str, *parts: str) -> str:
    prefix = f"WITH {ctes.strip()} " if ctes else ""
    return prefix + "\nUNION ALL\n".join(parts)


ORACLES["dq_not_null"] = _verdicts(CONTRACTS, *[
    _verdict("not_null", c, {
        "amount": "SELECT count(*) FROM contracts WHERE amount = 0",
        "external_contract_id": "SELECT count(*) FROM contracts WHERE external_contract_id LIKE '%-4'",
    }.get(c, f"SELECT count(*) FROM contracts WHERE {c} IS NULL"))
    for c in (GROUPING + ", effective_from_date, effective_to_date").split(", ")])


def _repeats(columns: str, table: str) -> str:
    return f"SELECT count(*) FROM (SELECT {columns} FROM {table} GROUP BY {columns} HAVING count(*) > 1)"


BOTH_KINDS = CONTRACTS + "," + TIMELINE + FIRST_IDS
ORACLES["dq_unique"] = _verdicts(
    BOTH_KINDS,
    _verdict("unique", "contract_id, territory_id", _repeats("contract_id, territory_id", "contracts")),
    _verdict("unique", "contract_id, territory_id, effective_from_date",
             _repeats("contract_id, territory_id, effective_from_date", "contracts"), "warn"),
    _verdict("unique", "contract_identifier", _repeats("contract_identifier", "ids")),
    _verdict("unique", "contract_id, territory_id", _repeats("contract_id, territory_id", "ids")))
ORACLES["dq_duplicate_keys"] = shaped(CONTRACTS, """
SELECT contract_id, territory_id, effective_from_date, count(*) AS n_records
FROM contracts GROUP BY ALL HAVING count(*) > 1""", "effective_from_date")
DIM_CTES = BOTH_DAYS + f", dim AS ({_dim('effective_from_date')})"
ORACLES["dq_expression"] = _verdicts(
    DIM_CTES,
    *[_verdict("expression_is_true", n, f"SELECT count(*) FROM dim WHERE {bad}", "warn") for n, bad in (
        ("range_in_order", "effective_from_date > effective_to_date"),
        ("current_is_open", "is_current <> (effective_to_date = DATE '9999-12-31')"),
        ("amount_above_limit", "amount <= 100000"),
        ("null_fails", "territory_id = 103"))])
ORACLES["dq_recency"] = _verdicts(
    "",
    _verdict("recency", "ts", "SELECT CASE WHEN max(ts) >= TIMESTAMP '2024-01-29 12:00:00' THEN 0 ELSE 1 END FROM events"),
    _verdict("recency", "ts", "SELECT CASE WHEN max(ts) >= TIMESTAMP '2024-02-22 00:00:00' THEN 0 ELSE 1 END FROM events",
             "warn"))
ORACLES["dq_equal_rowcount"] = _verdicts(
    DAY2,
    _verdict("equal_rowcount", "history", "SELECT 0"),
    _verdict("equal_rowcount", "feed",
             "SELECT abs((SELECT count(*) FROM timeline) - (SELECT count(*) FROM day2))", "warn"))


def _suite(model: str, table: str, mandatory: str, others: list[tuple[str, str, str]]) -> list[str]:
    every = [("not_null", c, f"SELECT count(*) FROM {table} WHERE {c} IS NULL") for c in mandatory.split()] + others
    return [f"SELECT '{model}' AS model, *, '2001-12-31 06:00:00' AS checked_at FROM ({_verdict(*check)})" for check in every]


_DISORDER = "SELECT count(*) FROM {} WHERE effective_from_date > effective_to_date"
ORACLES["dq_contract_suite"] = _verdicts(
    CONSOLIDATED + """,
suite_ids AS (
  SELECT contract_id, territory_id, dense_rank() OVER (ORDER BY contract_id, territory_id) AS contract_identifier
  FROM consolidated GROUP BY contract_id, territory_id),
suite_dim AS (
  SELECT md5(contract_id || '-' || territory_id || '-' || CAST(effective_from_date AS VARCHAR)) AS contract_sk,
         contract_identifier, contract_id, territory_id
  FROM consolidated JOIN suite_ids USING (contract_id, territory_id))""",
    *_suite("staged", "contracts", f"{GROUPING}, effective_from_date, effective_to_date".replace(",", ""),
            [("not_null", "loaded_at", "SELECT 0"), ("expression_is_true", "range_in_order", _DISORDER.format("contracts"))]),
    *_suite("consolidated", "consolidated", "contract_id territory_id effective_from_date effective_to_date",
            [("not_null", "processed_at", "SELECT 0"), ("expression_is_true", "range_in_order", _DISORDER.format("consolidated")),
             ("recency", "processed_at", "SELECT 0")]),
    *_suite("identifiers", "suite_ids", "contract_id territory_id contract_identifier",
            [("unique", "contract_identifier", _repeats("contract_identifier", "suite_ids")),
             ("unique", "contract_id, territory_id", _repeats("contract_id, territory_id", "suite_ids"))]),
    *_suite("dimension", "suite_dim", "contract_sk contract_identifier contract_id territory_id",
            [("unique", "contract_sk", _repeats("contract_sk", "suite_dim")), ("expression_is_true", "current_is_open", "SELECT 0")]))
ORACLES["dq_freshness"] = """
SELECT strftime(m, '%Y-%m-%d %H:%M:%S') AS max_loaded_at,
       round((epoch_us(t) - epoch_us(m)) / 3.6e9, 4) AS age_hours,
       CASE WHEN t - m > INTERVAL 48 HOUR THEN 'error' WHEN t - m > INTERVAL 24 HOUR THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max(ts) AS m FROM events),
     (VALUES (TIMESTAMP '2024-01-30 12:00:00'), (TIMESTAMP '2024-01-31 12:00:00'), (TIMESTAMP '2024-02-05 12:00:00')) r(t)"""

# --- calendar, metadata and layouts -----------------------------------------------------------

ORACLES["first_working_day"] = shaped("", """
SELECT first_working_day, count(*) AS n_orders,
       count(*) FILTER (CAST(o_orderdate AS DATE) = first_working_day) AS n_on_day
FROM (SELECT o_orderdate, (SELECT min(d) FROM (
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) + CAST(i AS INTEGER) AS d FROM range(0, 3) r(i)) WHERE isodow(d) <= 5)
        AS first_working_day FROM orders)
GROUP BY first_working_day""", "first_working_day")
ORACLES["tag_period"] = """
SELECT o_orderkey AS sales_id, o_totalprice AS sales_amount, '2024-12-01' AS today_date,
       '2024-11-30' AS yesterday_date, '202411' AS period_key,
       strftime(CAST(o_orderdate AS DATE) - 1, '%Y%m') AS order_period
FROM orders"""
EVENT_TYPES = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
               "value": "double", "props": "string"}
CATALOG = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, "
    f"CASE WHEN count(*) > count({c if c != 'event_type' else chr(39).join(['nullif(event_type, ', 'error', ')'])}) "
    f"THEN 'YES' ELSE 'NO' END AS is_nullable, CAST({i} AS BIGINT) AS ordinal_position FROM events"
    for i, (c, t) in enumerate(EVENT_TYPES.items(), start=1))
ORACLES["schema_catalog"] = CATALOG
ORACLES["schema_ddl"] = f"""
SELECT 'CREATE TABLE events_copy (' || chr(10) || string_agg(
         '    ' || column_name || ' ' || data_type || CASE WHEN is_nullable = 'NO' THEN ' NOT NULL' ELSE '' END,
         ',' || chr(10) ORDER BY ordinal_position) || chr(10) || ');' AS ddl
FROM ({CATALOG})"""
ORACLES["append_roundtrip"] = shaped(DAY2, """
SELECT effective_to_date, count(*) AS n_rows, sum(amount) AS amount
FROM (SELECT * FROM timeline UNION ALL SELECT * FROM day2) GROUP BY ALL""", "effective_to_date", "amount")
ORACLES["partitioned_roundtrip"] = shaped("", """
SELECT CAST(ts AS DATE) AS partition_date, count(*) AS n_events, max(value) AS max_value
FROM events GROUP BY ALL""", "partition_date")
ORACLES["clustered_roundtrip"] = shaped(TIMELINE, """
SELECT CAST(date_trunc('month', effective_from_date) AS DATE) AS effective_month, territory_id, count(*) AS n_rows,
       max(amount) AS max_amount
FROM timeline GROUP BY ALL""", "effective_month", "max_amount")
ORACLES["snapshot_publish"] = shaped(DAY2, """
SELECT territory_id, count(*) AS n_rows, sum(amount) AS amount
FROM (SELECT t.* FROM timeline t ANTI JOIN day2 d USING (contract_id, territory_id, effective_from_date)
      UNION ALL SELECT * FROM day2)
GROUP BY territory_id""", double="amount")
ORACLES["table_by_name"] = shaped(CONTRACTS, """
SELECT territory_id, count(*) AS n_rows, sum(amount) AS amount FROM contracts GROUP BY territory_id""", double="amount")
ORACLES["sample_limit"] = """
SELECT least(count(*), 100) AS n_rows, least(count(*), 100) AS n_from_table FROM lineitem"""
ORACLES["kmeans_facts"] = """
SELECT count(*) AS n_rows, CAST(3 AS BIGINT) AS n_clusters, CAST(0 AS BIGINT) AS n_not_nearest, CAST(10 AS BIGINT) AS n_top,
       CAST(0 AS BIGINT) AS n_farther
FROM lineitem"""

ORACLES["kmeans_stored"] = """
SELECT count(*) AS n_rows, CAST(3 AS BIGINT) AS n_clusters, 'v1' AS model_version, CAST(0 AS BIGINT) AS n_bad_distances, true AS same_model,
       'v2' AS newest, CAST(4 AS BIGINT) AS n_centres
FROM lineitem"""

# --- newest copies as a stream -------------------------------------------------------------

ORACLES["stream_newest"] = shaped(RECORDS + """,
newest AS (
  SELECT * REPLACE (updated_at + CASE WHEN product_name IS NULL THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END
                    AS updated_at)
  FROM records)""", FLAT.format(records="newest"), f"updated_at partition_date {INDEXES}")
_COPIES = RECORDS + """,
copies AS (
  SELECT record_id, updated_at, product_name FROM records
  UNION ALL SELECT record_id, updated_at + INTERVAL 1 HOUR, product_name FROM records WHERE product_name IS NULL),
delivered AS (
  SELECT record_id, updated_at, CASE CAST(record_id AS BIGINT) % 7 % 3 WHEN 1 THEN 1 WHEN 0 THEN 2 ELSE 3 END AS delivery FROM copies),
judged AS (
  SELECT d.*, coalesce(updated_at < (SELECT max(e.updated_at) FROM delivered e WHERE e.delivery < d.delivery) - INTERVAL 30 MINUTE, false) AS late
  FROM delivered d)"""
ORACLES["stream_late"] = shaped(_COPIES, """
SELECT record_id, max(updated_at) AS updated_at, 'newest' AS kind FROM judged WHERE NOT late GROUP BY record_id
UNION ALL SELECT record_id, updated_at, 'late' FROM judged WHERE late""", "updated_at")

# --- facts in validity ranges -----------------------------------------------------------

ORACLES["orders_contract_version"] = shaped(CONTRACTS, """
SELECT o_orderkey, o_custkey AS contract_id, CAST(o_orderdate AS DATE) + 400 AS due_date, count(c.contract_id) AS n_ranges,
       sum(amount) AS amount, min(effective_from_date) AS first_from, max(effective_to_date) AS last_to
FROM orders LEFT JOIN contracts c ON c.contract_id = o_custkey
     AND CAST(o_orderdate AS DATE) + 400 BETWEEN effective_from_date AND effective_to_date
GROUP BY ALL""", "due_date first_from last_to", "amount")
ORACLES["valid_by_order_day"] = shaped(TIMELINE + """,
wanted AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, 100 + o_custkey % 7 AS territory_id FROM orders)""", """
SELECT w.territory_id, day, count(*) AS n_versions, sum(amount) AS amount
FROM wanted w JOIN timeline t ON t.territory_id = w.territory_id AND day BETWEEN effective_from_date AND effective_to_date
GROUP BY ALL""", "day", "amount")

# --- profiles that grow with their table --------------------------------------------------

_SKETCHED = (("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_orderkey", "bigint"))
ORACLES["profile_incremental"] = "\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS total_count, count(*) - count({c}) AS null_count,
       CAST(min({c}) AS DOUBLE) AS min_number, CAST(max({c}) AS DOUBLE) AS max_number, round(avg({c}), 3) AS avg_value,
       round(stddev_samp({c}), 3) AS stddev_value, true AS distinct_within, true AS quartiles_within,
       count(DISTINCT CASE WHEN year(l_shipdate) < 1998 THEN year(l_shipdate) END) AS n_read_first,
       count(DISTINCT CASE WHEN year(l_shipdate) >= 1998 THEN year(l_shipdate) END) AS n_read_later
FROM lineitem""" for c, t in _SKETCHED)
ORACLES["profile_over_time"] = "\nUNION ALL\n".join(f"""
SELECT CAST(year(l_shipdate) AS VARCHAR) AS ship_year, '{c}' AS column_name, count(*) AS total_count, count(*) - count({c}) AS null_count,
       CAST(min({c}) AS DOUBLE) AS min_number, CAST(max({c}) AS DOUBLE) AS max_number, round(avg({c}), 3) AS avg_value
FROM lineitem GROUP BY 1""" for c, t in _SKETCHED)

# --- writes that are audited before they are shown ----------------------------------------

_AUDITED = """
source AS (
  SELECT o_orderkey AS order_key, o_orderkey % 50 = 0 AS no_name, CAST(round(c_acctbal, 2) AS DECIMAL(12,2)) < 0 AS negative,
         CAST(o_orderdate AS DATE) >= DATE '2001-06-01' AS late, o_orderkey % 11 <> 0 AS not_open
  FROM orders JOIN customer ON o_custkey = c_custkey),
versions AS (
  SELECT 'v1' AS version, * FROM source UNION ALL SELECT 'v2', * FROM source WHERE order_key % 2 = 0
  UNION ALL SELECT 'v3', * FROM source UNION ALL SELECT 'v3', * FROM source WHERE order_key % 100 = 1)"""
ORACLES["audited_verdicts"] = shaped(_AUDITED + """,
counted AS (
  SELECT version, count(*) AS n, count(*) FILTER (no_name OR negative OR late) AS bad, count(*) FILTER (no_name) AS no_name,
         count(*) FILTER (negative) AS negative, count(*) FILTER (late) AS late, count(*) FILTER (not_open) AS not_open
  FROM versions GROUP BY version),
repeated AS (
  SELECT version, count(*) FILTER (k > 1) AS k FROM (
    SELECT version, order_key, count(*) AS k FROM versions WHERE NOT (no_name OR negative OR late) GROUP BY ALL) GROUP BY version),
verdicts AS (
  SELECT version, 'not_null' AS check_name, 'contract_id' AS subject, 0 AS failures, 'error' AS severity FROM counted
  UNION ALL SELECT version, 'not_null', 'external_contract_id', no_name, 'error' FROM counted
  UNION ALL SELECT version, 'expression_is_true', 'amount_not_negative', negative, 'error' FROM counted
  UNION ALL SELECT version, 'expression_is_true', 'open_end', not_open, 'warn' FROM counted
  UNION ALL SELECT version, 'expression_is_true', 'starts_in_time', late, 'error' FROM counted
  UNION ALL SELECT version, 'unique', 'order_key', k, 'error' FROM repeated)""", """
SELECT version, check_name, subject, failures, CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status, severity,
       version = 'v1' AS published, n - bad AS n_good, bad AS n_quarantined
FROM verdicts JOIN counted USING (version)""")
ORACLES["audited_rows"] = shaped(_AUDITED, """
SELECT order_key, 'published' AS kind, '' AS failed FROM versions WHERE version = 'v1' AND NOT (no_name OR negative OR late)
UNION ALL
SELECT order_key, 'quarantined',
       concat_ws(' ', CASE WHEN no_name THEN 'not_null(external_contract_id)' END, CASE WHEN negative THEN 'expression_is_true(amount_not_negative)' END,
                 CASE WHEN not_open THEN 'expression_is_true(open_end)' END, CASE WHEN late THEN 'expression_is_true(starts_in_time)' END)
FROM versions WHERE version = 'v2' AND (no_name OR negative OR late)""")

# --- schemas that change --------------------------------------------------------------------

ORACLES["schema_evolution"] = """
SELECT c_custkey AS customer_id, c_name AS full_name,
       CASE WHEN c_custkey % 3 < 2 THEN CAST(CAST(round(c_acctbal, 2) AS DECIMAL(12,2)) AS DOUBLE) END AS balance,
       CASE c_custkey % 3 WHEN 0 THEN -1 - c_custkey % 5 WHEN 1 THEN CAST(c_nationkey AS BIGINT) END AS nation,
       CASE WHEN c_custkey % 3 = 2 THEN 'new' END AS note
FROM customer"""

# --- macros in SQL ---------------------------------------------------------------------------

ORACLES["sql_macros_rows"] = shaped("""
d AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders)""", """
SELECT o_orderkey, strftime(d - 1, '%Y%m') AS lag_period, strftime(d - 1, '%Y-%m-%d') AS yesterday,
       (SELECT min(x) FROM (SELECT unnest([0, 1, 2]) AS i) t(i), (SELECT CAST(date_trunc('month', d) AS DATE) + i AS x)
        WHERE isodow(x) < 6) AS first_working_day,
       ('0x' || substr(md5(o_custkey || '-' || (100 + o_custkey % 7)), 1, 15))::BIGINT AS contract_hash,
       md5(o_custkey || '-' || (100 + o_custkey % 7) || '-' || strftime(d, '%Y-%m-%d')) AS contract_key
FROM d WHERE d >= DATE '1996-01-01'""", "first_working_day")
ORACLES["sql_script"] = shaped(HISTORY, """
SELECT territory_id, '199912' AS period, count(*) AS n_contracts, sum(amount) AS amount
FROM history WHERE DATE '1999-12-31' BETWEEN effective_from_date AND effective_to_date GROUP BY territory_id""", double="amount")
