"""The same queries as SQL over the driver's tables, written against the tables directly."""

from __future__ import annotations

SALT = "test-salt"

ORD = """
ord AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, merchant_id,
         o_orderdate AS order_created_at,
         ' ' || lpad(CAST(o_custkey AS VARCHAR), 11, '0') || ' ' AS cpf, o_totalprice
  FROM orders
  LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS merchant_id FROM lineitem GROUP BY l_orderkey)
    ON l_orderkey = o_orderkey)"""

CONSUMER = """
consumer AS (
  SELECT c_custkey AS customer_id, right(c_name, 9) AS customer_phone_number, c_mktsegment
  FROM customer)"""

MERCHANT = "merchant AS (SELECT s_suppkey AS id, s_name, s_nationkey FROM supplier)"

STATUS = """
status AS (
  SELECT l_orderkey AS order_id,
         CASE l_returnflag || l_linestatus
           WHEN 'AF' THEN 'REGISTERED' WHEN 'NF' THEN 'PLACED'
           WHEN 'NO' THEN 'CONCLUDED' WHEN 'RF' THEN 'CANCELLED'
           ELSE l_returnflag || l_linestatus END AS status_value,
         l_shipdate AS status_created_at
  FROM lineitem)"""

LINE = """
line AS (
  SELECT l_orderkey AS order_id, p_brand AS brand, p_name, l_partkey, l_suppkey, l_linenumber,
         l_quantity, l_returnflag, l_linestatus,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS price,
         CAST(round(l_tax * 100) AS BIGINT) AS tax,
         CAST(round(l_discount * 100) AS BIGINT) AS discount,
         CAST(round(p_retailprice * 100) AS BIGINT) AS retail
  FROM lineitem JOIN part ON l_partkey = p_partkey),
kept AS (
  SELECT order_id, brand, l_linenumber, min(p_name) AS p_name, min(l_partkey) AS l_partkey,
         min(l_suppkey) AS l_suppkey, sum(l_quantity) AS l_quantity, min(l_returnflag) AS l_returnflag,
         min(l_linestatus) AS l_linestatus, CAST(sum(price) AS BIGINT) AS price,
         CAST(sum(tax) AS BIGINT) AS tax, CAST(sum(discount) AS BIGINT) AS discount, min(retail) AS retail
  FROM line WHERE l_returnflag <> 'R' GROUP BY order_id, brand, l_linenumber),
item AS (
  SELECT order_id, brand AS name, sum(l_quantity) AS quantity,
         CAST(min(l_partkey) AS VARCHAR) AS external_id, '0' AS integration_id,
         CASE WHEN count(*) > 1 THEN max(l_linestatus) END AS customer_note,
         CAST(count(*) AS VARCHAR) AS addition, CAST(sum(discount) AS VARCHAR) AS discount,
         CAST(max(price) AS VARCHAR) AS unit_price, CAST(sum(price) AS VARCHAR) AS total_value,
         CAST(sum(tax) AS VARCHAR) AS total_addition,
         CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS VARCHAR) AS total_discount
  FROM line GROUP BY order_id, brand),
garnishes AS (
  SELECT order_id, brand, count(*) AS garnishes FROM kept GROUP BY order_id, brand)"""

ITEM_COLUMNS = """
  i.name, i.quantity, i.external_id, i.integration_id, i.customer_note,
  i.addition, 'USD' AS addition_currency, i.discount, 'USD' AS discount_currency,
  i.unit_price, 'USD' AS unit_price_currency, i.total_value, 'USD' AS total_value_currency,
  i.total_addition, 'USD' AS total_addition_currency,
  i.total_discount, 'USD' AS total_discount_currency"""

GARNISH = """
garnish AS (
  SELECT DISTINCT order_id, p_name AS garnish_name, l_quantity AS garnish_quantity,
         CAST(l_linenumber AS BIGINT) AS garnish_sequence,
         CAST(l_suppkey AS VARCHAR) AS garnish_external_id,
         CAST(l_partkey AS VARCHAR) AS garnish_integration_id,
         l_returnflag AS garnish_category_id, l_linestatus AS garnish_category_name,
         CAST(tax AS VARCHAR) AS garnish_addition, 'USD' AS garnish_addition_currency,
         CAST(discount AS VARCHAR) AS garnish_discount, 'USD' AS garnish_discount_currency,
         CAST(retail AS VARCHAR) AS garnish_unit_price, 'USD' AS garnish_unit_price_currency,
         CAST(price AS VARCHAR) AS garnish_total_value, 'USD' AS garnish_total_value_currency
  FROM kept)"""

ITEM_ROWS = f"""
WITH {LINE}
SELECT i.order_id, i.name, i.quantity, i.external_id, i.customer_note, i.total_value,
       CAST(coalesce(g.garnishes, 0) AS INTEGER) AS garnishes
FROM item i LEFT JOIN garnishes g
  ON g.order_id = i.order_id AND g.brand = i.name"""

ITEM_IDS = """
item_id AS (
  SELECT DISTINCT order_id, brand, CAST(l_suppkey AS VARCHAR) AS garnish_external_id
  FROM kept)"""

ORDER_ITEMS = f"""
WITH {LINE}, {GARNISH}, {ITEM_IDS}
SELECT {ITEM_COLUMNS}, g.*
FROM item i
JOIN item_id d ON d.order_id = i.order_id AND d.brand = i.name
JOIN garnish g ON g.order_id = d.order_id AND g.garnish_external_id = d.garnish_external_id"""

RANKED_ORDER = """row_number() OVER (
    PARTITION BY customer_id ORDER BY order_created_at DESC NULLS LAST, order_id DESC) AS rn"""

RANKED_STATUS = """row_number() OVER (
    PARTITION BY order_id ORDER BY status_created_at DESC NULLS LAST, status_value DESC) AS rn"""

STATUS_COLUMNS = ", ".join(
    f"s{k}.status_value AS status_{k}, s{k}.status_created_at AS status_created_at_{k}"
    for k in range(1, 5)
)


def _step(k: int, name: str, on: str, kind: str = "LEFT JOIN", agg: bool = False) -> str:
    columns = "order_id, status_value, max(status_created_at) AS status_created_at" if agg else "*"
    group = " GROUP BY order_id, status_value" if agg else ""
    return (
        f"{kind} (SELECT {columns} FROM status WHERE status_value = '{name}'{group}) s{k} "
        f"ON s{k}.order_id = {on}.order_id"
    )


STEPS = ("REGISTERED", "PLACED", "CONCLUDED", "CANCELLED")


def _statuses(joins: list[str]) -> str:
    return (
        f"WITH {ORD}, {STATUS} SELECT DISTINCT o.order_id, {STATUS_COLUMNS} FROM ord o "
        + " ".join(joins)
    )


FOUR_JOINS = _statuses([_step(k, s, "o") for k, s in enumerate(STEPS, 1)])
LATEST_STEPS = _statuses([_step(k, s, "o", agg=True) for k, s in enumerate(STEPS, 1)])
FUNNEL = _statuses(
    [
        _step(k, s, "o" if k == 1 else f"s{k - 1}", "JOIN" if k == 1 else "LEFT JOIN")
        for k, s in enumerate(STEPS, 1)
    ]
)


CHOSEN = f"""
chosen AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT ord.*, TRY_CAST(customer_phone_number AS BIGINT) * 5 / 2 AS customer_phone_number,
           c_mktsegment, merchant.*, {RANKED_ORDER.replace("customer_id", "ord.customer_id")}
    FROM ord JOIN consumer ON consumer.customer_id = ord.customer_id
    JOIN merchant ON merchant.id = ord.merchant_id)
  WHERE rn = 1),
last_status AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, {RANKED_STATUS} FROM status) WHERE rn = 1),
trusted AS (
  SELECT chosen.* EXCLUDE (cpf), sha256(trim(cpf) || '{SALT}') AS cpf, status_created_at,
         status_value, DATE '2024-01-31' AS partition
  FROM chosen JOIN last_status ON last_status.order_id = chosen.order_id)"""


def _gated(day2: str, actual: str, written: str) -> str:
    return f"""
WITH {ORD}, {MERCHANT}, first_day AS (SELECT count(*) AS n FROM ord), second_day AS ({actual})
SELECT days.partition, days.row_count, 'order' AS dataset, s.n AS actual, f.n AS previous,
       {written} AS written
FROM (SELECT DATE '2024-01-30' AS partition, (SELECT n FROM first_day) AS row_count {day2}) days,
     first_day f, second_day s"""


ORACLE = {
    "csv_scan": "SELECT * FROM customer",
    "json_scan": "SELECT * FROM events",
    "raw_ingest": """
SELECT 'customer' AS dataset, c_custkey AS id, c_name AS label, DATE '2024-01-31' AS partition_column FROM customer
UNION ALL SELECT 'events', event_id, event_type, DATE '2024-01-31' FROM events""",
    "parquet_unpartitioned": "SELECT * FROM part",
    "raw_scan_renamed": f"WITH {STATUS} SELECT * FROM status",
    "partition_scan_day": """
SELECT *, CAST(ts AS DATE) AS partition FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""",
    "gated_write_pass": _gated(
        "UNION ALL SELECT DATE '2024-01-31', (SELECT n FROM second_day)",
        "SELECT count(*) AS n FROM ord JOIN merchant ON merchant.id = ord.merchant_id",
        "true",
    ),
    "gated_write_refused": _gated("", "SELECT count(DISTINCT customer_id) AS n FROM ord", "false"),
    "view_sql_filter": f"WITH {STATUS} SELECT * FROM status WHERE status_value = 'PLACED'",
    "equality_filter": f"WITH {STATUS} SELECT * FROM status WHERE status_value = 'CANCELLED'",
    "table_profile": """
SELECT count(*) AS row_count, count(DISTINCT o_orderkey) AS distinct_o_orderkey,
       count(DISTINCT o_custkey) AS distinct_o_custkey,
       CAST(max(length(o_orderpriority)) AS INTEGER) AS max_length_o_orderpriority FROM orders""",
    "preview_rows": "SELECT * FROM events ORDER BY event_id LIMIT 20",
    "duplicate_keys": f"""
WITH {STATUS} SELECT order_id, CAST(status_created_at AS DATE) AS day, count(*) AS count
FROM status GROUP BY 1, 2 HAVING count(*) > 1""",
    "distinct_rows": f"WITH {STATUS} SELECT DISTINCT order_id, status_value FROM status",
    "id_lengths": """
SELECT CAST(length(p_name) AS INTEGER) AS length, CAST(max(length(p_name)) AS INTEGER) AS max_length,
       count(*) AS count FROM part GROUP BY length(p_name)""",
    "orders_consumers": f"""
WITH {ORD}, {CONSUMER} SELECT ord.*, customer_phone_number, c_mktsegment
FROM ord JOIN consumer ON consumer.customer_id = ord.customer_id""",
    "orders_merchants": f"WITH {ORD}, {MERCHANT} SELECT * FROM ord JOIN merchant ON id = merchant_id",
    "latest_order_per_customer": f"""
WITH {ORD} SELECT * EXCLUDE (rn) FROM (SELECT *, {RANKED_ORDER} FROM ord) WHERE rn = 1""",
    "latest_status_per_order": f"""
WITH {STATUS} SELECT * EXCLUDE (rn) FROM (SELECT *, {RANKED_STATUS} FROM status) WHERE rn = 1""",
    "limited_orders": f"""
WITH {ORD}, {MERCHANT} SELECT * FROM ord JOIN merchant ON id = merchant_id
ORDER BY order_created_at, order_id LIMIT 1000""",
    "anonymized_customers": f"""
SELECT c_custkey, sha256(trim(c_name) || '{SALT}') AS c_name,
       sha256(trim('  ' || c_mktsegment || ' ') || '{SALT}') AS c_mktsegment FROM customer""",
    "masked_numbers": """
SELECT c_custkey AS customer_id, TRY_CAST(right(c_name, 9) AS BIGINT) * 5 / 2 AS masked_number,
       TRY_CAST(c_mktsegment AS BIGINT) * 5 / 2 AS masked_text FROM customer""",
    "run_day": "SELECT event_id, CAST(ts - INTERVAL 3 HOUR AS DATE) AS day FROM events",
    "items_parsed": ITEM_ROWS,
    "items_inferred": ITEM_ROWS,
    "items_inferred_by_day": ITEM_ROWS,
    "malformed_documents": """
SELECT DISTINCT l_orderkey AS order_id FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_orderkey % 3 = 0""",
    "file_inventory": "SELECT DISTINCT CAST(ts AS DATE) AS day FROM events",
    "item_detail": f"""
WITH {LINE}, {ITEM_IDS}
SELECT i.order_id, {ITEM_COLUMNS}, d.garnish_external_id, CAST(g.garnishes AS INTEGER) AS garnish_items
FROM item i
JOIN item_id d ON d.order_id = i.order_id AND d.brand = i.name
JOIN garnishes g ON g.order_id = i.order_id AND g.brand = i.name""",
    "garnish_detail": f"WITH {LINE}, {GARNISH} SELECT * FROM garnish",
    "order_items": ORDER_ITEMS,
    "order_items_joined": ORDER_ITEMS,
    "order_items_per_item": f"""
WITH {LINE}, {GARNISH}
SELECT {ITEM_COLUMNS}, g.*
FROM item i
JOIN kept k ON k.order_id = i.order_id AND k.brand = i.name
JOIN garnish g ON g.order_id = k.order_id AND g.garnish_external_id = CAST(k.l_suppkey AS VARCHAR)
 AND g.garnish_integration_id = CAST(k.l_partkey AS VARCHAR) AND g.garnish_sequence = k.l_linenumber
 AND g.garnish_quantity = k.l_quantity AND g.garnish_total_value = CAST(k.price AS VARCHAR)
 AND g.garnish_addition = CAST(k.tax AS VARCHAR) AND g.garnish_discount = CAST(k.discount AS VARCHAR)
 AND g.garnish_category_id = k.l_returnflag AND g.garnish_category_name = k.l_linestatus""",
    "items_wide": f"""
WITH {LINE},
docs AS (
  SELECT order_id, count(*) AS items, string_agg(name, ',' ORDER BY name) AS names,
         string_agg(external_id, ',' ORDER BY external_id) AS external_ids,
         string_agg(total_value, ',' ORDER BY total_value) AS total_values,
         string_agg('USD', ',') AS currencies
  FROM item GROUP BY order_id),
loose AS (
  SELECT order_id, string_agg(p_name, ',' ORDER BY p_name) AS garnish_names,
         string_agg(CAST(l_suppkey AS VARCHAR), ',' ORDER BY CAST(l_suppkey AS VARCHAR)) AS garnish_ids,
         string_agg(CAST(price AS VARCHAR), ',' ORDER BY CAST(price AS VARCHAR)) AS garnish_values,
         sum(l_quantity) AS garnish_quantity
  FROM kept GROUP BY order_id)
SELECT d.order_id, CAST(d.items AS INTEGER) AS items, d.names, d.external_ids, d.total_values,
       d.currencies, CAST(d.items AS INTEGER) AS garnish_lists,
       coalesce(garnish_names, '') AS garnish_names, coalesce(garnish_ids, '') AS garnish_ids,
       coalesce(garnish_values, '') AS garnish_values, coalesce(garnish_quantity, 0.0) AS garnish_quantity
FROM docs d LEFT JOIN loose g ON g.order_id = d.order_id""",
    "trusted_order": f"WITH {ORD}, {CONSUMER}, {MERCHANT}, {STATUS}, {CHOSEN} SELECT * FROM trusted",
    "trusted_lake": f"""
WITH {ORD}, {CONSUMER}, {MERCHANT}, {STATUS}, {CHOSEN}, {LINE}, {GARNISH}, {ITEM_IDS},
item_rows AS (
  SELECT i.order_id FROM item i
  JOIN trusted t ON t.order_id = i.order_id
  JOIN item_id d ON d.order_id = i.order_id AND d.brand = i.name
  JOIN garnish g ON g.order_id = d.order_id AND g.garnish_external_id = d.garnish_external_id),
status_rows AS (
  SELECT DISTINCT o.order_id, {STATUS_COLUMNS} FROM trusted o
  {" ".join(_step(k, s, "o") for k, s in enumerate(STEPS, 1))})
SELECT 'order' AS dataset, true AS written, count(*) AS row_count, count(DISTINCT order_id) AS orders FROM trusted
UNION ALL SELECT 'order_items', true, count(*), count(DISTINCT order_id) FROM item_rows
UNION ALL SELECT 'order_statuses', true, count(*), count(DISTINCT order_id) FROM status_rows""",
    "trusted_order_incremental": f"WITH {ORD}, {CONSUMER}, {MERCHANT}, {STATUS}, {CHOSEN} SELECT * FROM trusted",
    "orders_status_colocated": f"""
WITH {ORD}, {STATUS}
SELECT ord.*, status_value, status_created_at FROM ord
JOIN (SELECT * EXCLUDE (rn) FROM (SELECT *, {RANKED_STATUS} FROM status) WHERE rn = 1) s
  ON s.order_id = ord.order_id""",
    "evolved_scan": """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority ELSE 'NONE' END AS o_orderpriority,
       CASE WHEN o_orderkey % 2 = 1 THEN DATE '2024-01-31' ELSE DATE '2024-01-30' END AS partition_column
FROM orders""",
    "quarantined_records": """
SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS c_name,
       CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS c_acctbal, c_custkey % 7 = 0 AS set_aside
FROM customer""",
    "order_statuses": FOUR_JOINS,
    "order_statuses_one_pass": FOUR_JOINS,
    "order_statuses_latest": LATEST_STEPS,
    "order_status_funnel": FUNNEL,
}
