"""The expected answer of each query as DuckDB SQL over the same tables.

Where a query parses text, the SQL starts from the clean column the text was made of, so it checks the
parser instead of repeating it. Named parts are put in front of a statement as common table expressions,
in the order of their definition here.
"""

import re

PARTS: dict[str, str] = {}


def _ts(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


PARTS["docs"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       'O' || l_orderkey || '-' || l_linenumber AS order_id,
       CASE WHEN l_partkey % 101 = 9 THEN NULL
            WHEN l_partkey % 89 = 5 THEN ''
            WHEN l_partkey % 97 = 7 THEN 'X' || o_custkey
            ELSE 'C' || o_custkey END AS customer_id,
       ['web', 'mobile', 'pos'][l_linenumber % 3 + 1] AS channel,
       CASE WHEN l_suppkey % 10 = 9 AND l_partkey % 50 = 0 THEN 'AZM'
            WHEN l_suppkey % 10 = 9 AND l_partkey % 50 = 1 THEN NULL
            ELSE ['AZN', 'AZN', 'AZN', 'USD', 'USD', 'EUR', 'EUR', 'TRY', 'TRY', 'AZN'][l_suppkey % 10 + 1]
            END AS currency,
       make_timestamp(seconds * 1000000) AS order_ts,
       make_timestamp((seconds + 86400) * 1000000 + l_suppkey % 1000 * 1000 + l_quantity::BIGINT) AS updated_at,
       CASE WHEN o_orderstatus = 'F' THEN CASE WHEN l_linenumber = 7 THEN 'REFUNDED' ELSE 'DELIVERED' END
            WHEN o_orderstatus = 'O' THEN 'SHIPPED'
            WHEN l_suppkey % 2 = 0 THEN 'CANCELLED' ELSE 'PACKED' END AS status,
       CASE WHEN l_partkey % 211 = 0 THEN 'Z' ELSE 'P' END || l_partkey AS product_id,
       CASE l_partkey % 301 WHEN 7 THEN 0 WHEN 8 THEN -1 ELSE l_quantity END::DECIMAL(10, 2) AS quantity,
       CASE WHEN l_partkey % 307 IN (11, 12) THEN NULL
            WHEN l_partkey % 307 = 13 THEN -l_extendedprice ELSE l_extendedprice END::DECIMAL(14, 4) AS unit_price,
       l_partkey % 401 IN (17, 18) AS without_items
FROM (SELECT lineitem.*, orders.*,
             (CASE WHEN l_partkey % 113 = 3 THEN 18062
                   ELSE date_diff('day', DATE '1970-01-01', o_orderdate::DATE) + 9500 END) * 86400
             + (l_partkey * 61 + l_linenumber * 7) % 86400 AS seconds
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
     (VALUES (0), (1)) AS copies(copy)
WHERE copy = 0 OR l_partkey % 70 = 11
"""
PARTS["versions"] = """
SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC) AS place FROM docs
"""
PARTS["custs"] = """
SELECT c_custkey, n, copy, c_name AS full_name, c_nationkey,
       CASE WHEN c_custkey % 201 = 10 THEN '' WHEN c_custkey % 203 = 12 THEN NULL
            ELSE 'C' || c_custkey END AS customer_id,
       ['Azerbaijan', 'Azerbaijan', 'Azerbaijan', 'Turkiye', 'Turkiye', NULL, 'Georgia', ''][c_nationkey % 8 + 1]
           AS country,
       CASE WHEN copy = 1 THEN 'OLD' WHEN n >= 2 AND c_custkey % 10 = 2 THEN 'VIP'
            WHEN n = 3 AND c_custkey % 15 = 1 THEN 'KEY' ELSE c_mktsegment END AS segment,
       DATE '2022-01-01' + (c_custkey % 300)::INTEGER AS signup_date,
       day::TIMESTAMP + CASE WHEN copy = 1 THEN INTERVAL 30 MINUTE ELSE INTERVAL 60 MINUTE END AS updated_at,
       day AS snapshot_date
FROM customer,
     (VALUES (1, DATE '2023-06-01'), (2, DATE '2024-06-01'), (3, DATE '2025-06-01')) AS days(n, day),
     (VALUES (0), (1)) AS copies(copy)
WHERE (copy = 0 OR c_custkey % 33 = 8)
  AND CASE n WHEN 1 THEN c_custkey % 20 <> 3 WHEN 2 THEN c_custkey % 25 <> 4 ELSE c_custkey % 50 <> 6 END
"""
PARTS["staged_customers"] = """
SELECT customer_id, full_name, country, segment, signup_date, updated_at, snapshot_date, n,
       CASE WHEN customer_id IS NULL OR customer_id = '' THEN 'missing_customer_id'
            WHEN copy = 1 THEN 'duplicate_customer_snapshot' END AS reason_code
FROM custs
"""
PARTS["prods"] = """
SELECT p_partkey, copy,
       CASE WHEN p_partkey % 53 = 10 THEN '' ELSE 'P' || p_partkey END AS product_id,
       CASE WHEN copy = 1 THEN 'old ' ELSE '' END || p_name AS product_name,
       CASE WHEN p_partkey % 31 IN (5, 6) THEN 'Uncategorized' ELSE p_type END AS category,
       CASE WHEN p_partkey % 37 = 4 THEN -5 WHEN p_partkey % 41 = 6 THEN NULL
            ELSE p_retailprice END::DECIMAL(14, 4) AS unit_price,
       CASE WHEN p_partkey % 43 = 7 THEN 'AZM' ELSE ['AZN', 'USD', 'EUR', 'TRY'][p_partkey % 4 + 1] END AS currency,
       make_timestamp((1767225600 + p_partkey - copy * 3600) * 1000000) AS updated_at
FROM part, (VALUES (0), (1)) AS copies(copy)
WHERE copy = 0 OR p_partkey % 29 = 9
"""
PARTS["staged_products"] = """
SELECT product_id, product_name, category, unit_price, currency, updated_at,
       CASE WHEN product_id = '' THEN 'missing_product_id'
            WHEN copy = 1 THEN 'duplicate_product'
            WHEN currency = 'AZM' THEN 'unsupported_currency'
            WHEN unit_price IS NULL THEN 'missing_unit_price'
            WHEN unit_price < 0 THEN 'negative_unit_price' END AS reason_code
FROM prods
"""
PARTS["items"] = """
SELECT order_id, place, customer_id, channel, currency, order_ts, updated_at, status,
       1 AS line_number, product_id, quantity, unit_price
FROM versions WHERE NOT without_items
UNION ALL
SELECT order_id, place, customer_id, channel, currency, order_ts, updated_at, status,
       2, 'P' || l_suppkey, 1::DECIMAL(10, 2), 100.25::DECIMAL(14, 4)
FROM versions WHERE NOT without_items AND l_linenumber % 2 = 0
"""
PARTS["staged_lines"] = """
SELECT order_id, line_number, customer_id, product_id, status, channel, currency, order_ts, updated_at,
       quantity, unit_price,
       CASE WHEN place > 1 THEN 'duplicate_order'
            WHEN customer_id IS NULL OR customer_id = '' THEN 'missing_customer_id'
            WHEN currency = 'AZM' THEN 'unsupported_currency'
            WHEN order_ts < TIMESTAMP '2020-01-01' THEN 'implausible_order_ts'
            WHEN unit_price IS NULL THEN 'missing_unit_price'
            WHEN unit_price < 0 THEN 'negative_unit_price'
            WHEN quantity <= 0 THEN 'invalid_quantity'
            WHEN customer_id NOT IN (SELECT customer_id FROM custs WHERE customer_id IS NOT NULL)
                THEN 'unknown_customer'
            WHEN product_id NOT IN (SELECT product_id FROM prods) THEN 'unknown_product' END AS reason_code
FROM items
"""
PARTS["lines"] = "SELECT * FROM staged_lines WHERE reason_code IS NULL"
PARTS["event_docs"] = """
SELECT CASE WHEN event_id % 1009 = 5 THEN NULL WHEN event_id % 1013 = 6 THEN '' ELSE 'E' || event_id END AS event_id,
       'O' || (event_id // 5) || '-' || (event_id // 5 % 7 + 1) AS order_id,
       CASE WHEN event_id % 211 = 3 THEN 'd' WHEN event_type = 'view' THEN 'c' ELSE 'u' END AS op,
       CASE WHEN event_type <> 'view' THEN 'CREATED' END AS old_status,
       CASE WHEN event_id % 211 = 3 THEN NULL
            WHEN event_type = 'view' THEN 'CREATED' WHEN event_type = 'click' THEN 'CONFIRMED'
            WHEN event_type = 'signup' THEN 'PACKED'
            WHEN event_type = 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 'SHIPPED' ELSE 'DELIVERED' END
            WHEN event_id % 3 = 0 THEN 'REFUNDED' ELSE 'CANCELLED' END AS new_status,
       ts AS event_ts, 'order-service' AS source
FROM events
"""
PARTS["staged_events"] = """
SELECT *, CASE WHEN event_id IS NULL OR event_id = '' THEN 'missing_event_id'
               WHEN order_id NOT IN (SELECT order_id FROM docs) THEN 'unknown_order' END AS reason_code
FROM event_docs
"""
PARTS["history"] = "SELECT * EXCLUDE (reason_code) FROM staged_events WHERE reason_code IS NULL"
PARTS["reconciled"] = """
SELECT d.order_id, d.api_status, e.event_status, coalesce(e.event_status, d.api_status) AS final_status,
       e.op AS latest_event_op,
       CASE WHEN e.op = 'd' THEN 'tombstone_erasure' WHEN e.order_id IS NULL THEN 'no_events_for_order'
            WHEN d.api_status IS DISTINCT FROM e.event_status THEN 'status_mismatch' ELSE 'match' END
           AS reconciliation_status
FROM (SELECT order_id, arg_max(status, updated_at) AS api_status FROM items GROUP BY order_id) d
LEFT JOIN (SELECT order_id, new_status AS event_status, op FROM history
           QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY event_ts DESC) = 1) e USING (order_id)
"""
PARTS["snapshots"] = "SELECT * FROM staged_customers WHERE reason_code IS NULL"
PARTS["dim_customer"] = """
SELECT md5(customer_id || ':' || valid_from) AS customer_key, customer_id, full_name, country, segment, signup_date,
       valid_from, valid_to, valid_to IS NULL AS is_current
FROM (SELECT customer_id, any_value(full_name) AS full_name, any_value(country) AS country,
             any_value(segment) AS segment, any_value(signup_date) AS signup_date,
             CASE WHEN min(n) = 1 THEN DATE '2020-01-01' ELSE min(snapshot_date) END AS valid_from,
             CASE max(n) WHEN 1 THEN DATE '2024-06-01' WHEN 2 THEN DATE '2025-06-01' END AS valid_to
      FROM (SELECT *, sum(starts) OVER (PARTITION BY customer_id ORDER BY n) AS version
            FROM (SELECT *, CASE WHEN lag(n) OVER w IS DISTINCT FROM n - 1
                                   OR lag(full_name) OVER w IS DISTINCT FROM full_name
                                   OR lag(country) OVER w IS DISTINCT FROM country
                                   OR lag(segment) OVER w IS DISTINCT FROM segment
                                   OR lag(signup_date) OVER w IS DISTINCT FROM signup_date
                                 THEN 1 ELSE 0 END AS starts
                  FROM snapshots WINDOW w AS (PARTITION BY customer_id ORDER BY n)))
      GROUP BY customer_id, version)
"""
PARTS["dim_product"] = """
SELECT product_id, product_name, category, CASE WHEN unit_price >= 0 THEN unit_price END AS list_price,
       CASE WHEN currency <> 'AZM' THEN currency END AS list_currency, reason_code IS NOT NULL AS has_catalog_issue
FROM staged_products WHERE product_id <> '' AND reason_code IS DISTINCT FROM 'duplicate_product'
"""
PARTS["rates"] = """
SELECT day AS rate_date, currency,
       ((base + date_diff('day', DATE '1970-01-01', day) % 7 * step) / 1000000.0)::DECIMAL(12, 6) AS rate_azn
FROM (SELECT DISTINCT o_orderdate::DATE + 9500 AS day FROM orders),
     (VALUES ('USD', 1700000, 1000), ('EUR', 1850000, 2500), ('TRY', 50000, 125)) AS bases(currency, base, step)
WHERE isodow(day) < 6 AND day >= DATE '2021-02-01'
"""
PARTS["dated"] = "SELECT *, (order_ts + INTERVAL 4 HOUR)::DATE AS local_day FROM lines"
PARTS["fact"] = """
SELECT l.order_id, l.line_number, c.customer_key, l.product_id,
       strftime(l.local_day, '%Y%m%d')::BIGINT AS order_date_key,
       l.local_day AS order_date_baku, l.quantity, l.unit_price, l.currency,
       CASE WHEN l.currency = 'AZN' THEN 1::DECIMAL(12, 6) ELSE r.rate_azn END AS rate_azn,
       l.quantity * l.unit_price AS gross_amount,
       (l.quantity * l.unit_price)::DECIMAL(25, 6)
           * CASE WHEN l.currency = 'AZN' THEN 1::DECIMAL(12, 6) ELSE r.rate_azn END AS gross_amount_azn,
       coalesce(s.final_status, l.status) AS final_status,
       coalesce(s.final_status, l.status) NOT IN ('CANCELLED', 'REFUNDED') AS is_recognized
FROM dated l
ASOF LEFT JOIN rates r ON l.currency = r.currency AND l.local_day >= r.rate_date
LEFT JOIN reconciled s ON s.order_id = l.order_id
LEFT JOIN dim_customer c ON c.customer_id = l.customer_id AND l.local_day >= c.valid_from
     AND (c.valid_to IS NULL OR l.local_day < c.valid_to)
"""
PARTS["sold"] = """
SELECT *, strptime(order_date_key::VARCHAR, '%Y%m%d')::DATE AS day FROM fact
WHERE is_recognized AND order_date_key IS NOT NULL
"""

STATUS_COLUMNS = f"event_id, order_id, op, old_status, new_status, {_ts('event_ts')} AS event_ts, source"
LINE_COLUMNS = f"""order_id, line_number::BIGINT AS line_number, customer_id, product_id, status, channel, currency,
    {_ts('order_ts')} AS order_ts, {_ts('updated_at')} AS updated_at, quantity::DOUBLE AS quantity,
    unit_price::DOUBLE AS unit_price"""
CUSTOMER_COLUMNS = f"""customer_id, full_name, country, segment, {_day('signup_date')} AS signup_date,
    {_ts('updated_at')} AS updated_at, {_day('snapshot_date')} AS snapshot_date"""
PRODUCT_COLUMNS = f"""product_id, product_name, category, unit_price::DOUBLE AS unit_price, currency,
    {_ts('updated_at')} AS updated_at"""
DIM_COLUMNS = f"""customer_key, customer_id, full_name, country, segment, {_day('signup_date')} AS signup_date,
    {_day('valid_from')} AS valid_from, {_day('valid_to')} AS valid_to, is_current"""
EVENT_LATE = "event_ts >= TIMESTAMP '2024-01-20' OR op <> 'd'"
EARLY = "TIMESTAMP '2025-06-01'"

# The staged lines of a run that had seen only the early documents.
PARTS["early_versions"] = f"""
SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC) AS place
FROM docs WHERE updated_at < {EARLY}
"""
PARTS["early_items"] = PARTS["items"].replace("FROM versions", "FROM early_versions")
PARTS["early_staged"] = PARTS["staged_lines"].replace("FROM items", "FROM early_items")
PARTS["changed"] = """
SELECT DISTINCT order_id FROM staged_lines
WHERE updated_at > (SELECT max(updated_at) FROM early_staged WHERE reason_code IS NULL)
"""
PARTS["changed_rejects"] = """
SELECT DISTINCT order_id FROM staged_lines
WHERE updated_at > (SELECT max(updated_at) FROM early_staged WHERE reason_code IS NOT NULL)
"""

SQL: dict[str, str] = {
    "slice_half_open": f"""
        SELECT o_orderkey, {_ts('o_orderdate')} AS o_orderdate, o_totalprice FROM orders
        WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1999-01-01'""",
    "json_fields": "SELECT event_id, (props->>'k')::BIGINT AS k FROM events",
    "parse_mixed_ts": f"SELECT order_id, {_ts('updated_at')} AS updated_at, {_ts('order_ts')} AS order_ts FROM docs",
    "ts_format_census": """
        SELECT ['epoch_ms', 'iso_utc', 'iso_offset', 'dotted_local'][l_linenumber % 4 + 1] AS format,
               count(*) AS row_count FROM docs GROUP BY 1""",
    "parse_price": f"""
        SELECT order_id, {_ts('updated_at')} AS updated_at, unit_price::DOUBLE AS unit_price FROM docs""",
    "norm_currency": "SELECT currency, count(*) AS row_count FROM docs GROUP BY 1",
    "norm_country": "SELECT country, count(*) AS row_count FROM custs GROUP BY 1",
    "local_date": f"SELECT event_id, {_day('ts + INTERVAL 4 HOUR')} AS local_day FROM events",
    "surrogate_key": """
        SELECT c_custkey, md5(c_custkey || ':' || CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END) AS key
        FROM customer""",
    "explode_items": """
        SELECT order_id, line_number::BIGINT AS line_number, count(*) AS row_count,
               sum(quantity)::DOUBLE AS quantity, sum(unit_price)::DOUBLE AS unit_price
        FROM items GROUP BY ALL""",
    "dedup_latest": f"""
        SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, {_ts('l_shipdate')} AS l_shipdate, l_partkey,
               l_suppkey, l_extendedprice
        FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""",
    "dedup_exact": f"SELECT {STATUS_COLUMNS} FROM event_docs",
    "ref_integrity": """
        SELECT customer_id, coalesce(customer_id IN (SELECT customer_id FROM custs WHERE customer_id IS NOT NULL),
                                     false) AS is_known, count(*) AS row_count
        FROM docs GROUP BY 1, 2""",
    "asof_fx": f"""
        SELECT o_orderkey, o.currency, {_day('o.day')} AS day,
               CASE WHEN o.currency = 'AZN' THEN 1.0 ELSE rate_azn::DOUBLE END::DOUBLE AS rate_azn
        FROM (SELECT o_orderkey, ['AZN', 'USD', 'EUR', 'TRY'][o_orderkey % 4 + 1] AS currency,
                     o_orderdate::DATE + 9500 AS day FROM orders) o
        ASOF LEFT JOIN rates ON o.currency = rates.currency AND o.day >= rate_date""",
    "asof_fx_large": f"""
        SELECT o_orderkey, o.currency, {_day('o.day')} AS day, rate_azn::DOUBLE AS rate_azn
        FROM (SELECT o_orderkey, ['AZN', 'USD', 'EUR', 'TRY'][o_orderkey % 4 + 1] AS currency,
                     o_orderdate::DATE + 9500 AS day FROM orders) o
        ASOF LEFT JOIN rates ON o.currency = rates.currency AND o.day >= rate_date""",
    "fx_missing_days": f"""
        SELECT {_day('day')} AS day FROM (
            SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate) - INTERVAL 1 DAY, INTERVAL 1 DAY))::DATE
                   + 9500 AS day FROM orders)
        WHERE day NOT IN (SELECT rate_date FROM rates)""",
    "dim_date": """
        SELECT strftime(day, '%Y%m%d')::BIGINT AS date_key, strftime(day, '%Y-%m-%d') AS date_day,
               year(day) AS year, month(day) AS month, day(day) AS day, rpad(monthname(day), 9, ' ') AS month_name,
               quarter(day) AS quarter, isodow(day) AS day_of_week, isodow(day) >= 6 AS is_weekend
        FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY))::DATE AS day
              FROM orders)""",
    "dim_customer_scd2": f"SELECT {DIM_COLUMNS} FROM dim_customer",
    "dim_customer_first_last": """
        WITH old AS (SELECT * FROM snapshots WHERE n = 1), new AS (SELECT * FROM snapshots WHERE n = 3),
        merged AS (
            SELECT o.customer_id, o.full_name, o.country, o.segment, o.signup_date, DATE '2020-01-01' AS valid_from,
                   CASE WHEN w.customer_id IS NULL OR row(o.full_name, o.country, o.segment, o.signup_date)
                        IS DISTINCT FROM row(w.full_name, w.country, w.segment, w.signup_date)
                        THEN DATE '2025-06-01' END AS valid_to
            FROM old o LEFT JOIN new w USING (customer_id)
            UNION ALL
            SELECT w.customer_id, w.full_name, w.country, w.segment, w.signup_date, DATE '2025-06-01', NULL
            FROM new w LEFT JOIN old o USING (customer_id)
            WHERE o.customer_id IS NULL OR row(o.full_name, o.country, o.segment, o.signup_date)
                  IS DISTINCT FROM row(w.full_name, w.country, w.segment, w.signup_date))
        SELECT md5(customer_id || ':' || valid_from) AS customer_key, customer_id, full_name, country, segment,
               strftime(signup_date, '%Y-%m-%d') AS signup_date, strftime(valid_from, '%Y-%m-%d') AS valid_from,
               strftime(valid_to, '%Y-%m-%d') AS valid_to, valid_to IS NULL AS is_current
        FROM merged""",
    "scd2_interval_join": f"""
        SELECT o_orderkey, o.customer_id, segment, {_day('valid_from')} AS valid_from
        FROM (SELECT o_orderkey, 'C' || o_custkey AS customer_id, o_orderdate::DATE + 9500 AS day FROM orders) o
        LEFT JOIN dim_customer c ON c.customer_id = o.customer_id AND day >= valid_from
             AND (valid_to IS NULL OR day < valid_to)""",
    "dim_product": """
        SELECT product_id, product_name, category, list_price::DOUBLE AS list_price, list_currency, has_catalog_issue
        FROM dim_product""",
    "reject_reasons": f"SELECT {LINE_COLUMNS}, reason_code FROM staged_lines",
    "reject_census": """
        SELECT reason_code, count(*) AS row_count, min(order_id) AS sample_id
        FROM staged_lines WHERE reason_code IS NOT NULL GROUP BY 1""",
    "stg_customers": f"SELECT {CUSTOMER_COLUMNS}, reason_code FROM staged_customers",
    "stg_products": f"SELECT {PRODUCT_COLUMNS}, reason_code FROM staged_products",
    "stg_events": f"SELECT {STATUS_COLUMNS}, reason_code FROM staged_events",
    "silver_order_lines": f"SELECT {LINE_COLUMNS} FROM lines",
    "silver_customers": f"SELECT {CUSTOMER_COLUMNS} FROM snapshots",
    "silver_products": f"SELECT {PRODUCT_COLUMNS} FROM staged_products WHERE reason_code IS NULL",
    "silver_status_history": f"SELECT {STATUS_COLUMNS} FROM history",
    "quarantine_order_lines": """
        SELECT md5(order_id || ':' || line_number || ':' || reason_code) AS quarantine_id,
               'silver_order_lines' AS source, reason_code, order_id AS payload_order_id,
               customer_id AS payload_customer_id, product_id AS payload_product_id, status AS payload_status,
               12::BIGINT AS payload_fields
        FROM staged_lines WHERE reason_code IS NOT NULL""",
    "quarantine_customers": """
        SELECT md5(customer_id || ':' || strftime(snapshot_date, '%Y-%m-%d') || ':' || reason_code) AS quarantine_id,
               'silver_customers' AS source, reason_code, customer_id AS payload_customer_id,
               segment AS payload_segment, strftime(signup_date, '%Y-%m-%d') AS payload_signup_date,
               8::BIGINT AS payload_fields
        FROM staged_customers WHERE reason_code IS NOT NULL""",
    "quarantine_products": """
        SELECT md5(product_id || ':' || reason_code) AS quarantine_id, 'silver_products' AS source, reason_code,
               product_id AS payload_product_id, product_name AS payload_product_name,
               currency AS payload_currency, 7::BIGINT AS payload_fields
        FROM staged_products WHERE reason_code IS NOT NULL""",
    "quarantine_events": """
        SELECT md5(coalesce(event_id, 'no_id') || ':' || coalesce(order_id, 'no_order') || ':' || reason_code)
                   AS quarantine_id, 'silver_order_events' AS source, reason_code, event_id AS payload_event_id,
               order_id AS payload_order_id, new_status AS payload_new_status, 8::BIGINT AS payload_fields
        FROM staged_events WHERE reason_code IS NOT NULL""",
    "status_reconciliation": "SELECT * FROM reconciled",
    "status_census": "SELECT reconciliation_status, count(*) AS order_count FROM reconciled GROUP BY 1",
    "fct_order_lines": f"""
        SELECT order_id, line_number::BIGINT AS line_number, customer_key, product_id, order_date_key,
               {_day('order_date_baku')} AS order_date_baku, quantity::DOUBLE AS quantity,
               unit_price::DOUBLE AS unit_price, currency, rate_azn::DOUBLE AS rate_azn,
               gross_amount::DOUBLE AS gross_amount, gross_amount_azn::DOUBLE AS gross_amount_azn, final_status,
               is_recognized FROM fact""",
    "fct_status_events": f"""
        SELECT event_id, order_id, op, old_status, new_status, {_ts('event_ts')} AS event_ts,
               strftime(day, '%Y%m%d')::BIGINT AS event_date_key, {_day('day')} AS event_date_baku
        FROM (SELECT *, (event_ts + INTERVAL 4 HOUR)::DATE AS day FROM history)""",
    "report_reconciliation": """
        SELECT 'bronze.orders' AS stage, count(*) AS row_count, NULL::DOUBLE AS gross_azn,
               NULL::DOUBLE AS recognized_azn FROM docs
        UNION ALL SELECT 'silver.order_lines (valid)', count(*), NULL, NULL FROM lines
        UNION ALL SELECT 'quarantine.order_lines', count(*), NULL, NULL
                  FROM staged_lines WHERE reason_code IS NOT NULL
        UNION ALL SELECT 'gold.fct_order_lines', count(*), round(sum(gross_amount_azn), 2)::DOUBLE,
                         round(sum(gross_amount_azn) FILTER (WHERE is_recognized), 2)::DOUBLE FROM fact""",
    "report_monthly_revenue": f"""
        SELECT {_day("date_trunc('month', day)")} AS month, category, country,
               round(sum(gross_amount_azn), 2)::DOUBLE AS recognized_revenue_azn
        FROM sold JOIN dim_product USING (product_id) JOIN dim_customer USING (customer_key)
        GROUP BY 1, 2, 3""",
    "monthly_revenue_table": f"""
        SELECT {_day("date_trunc('month', day)")} AS month, category, country,
               round(sum(gross_amount_azn), 2)::DOUBLE AS recognized_revenue_azn
        FROM sold JOIN dim_product USING (product_id) JOIN dim_customer USING (customer_key)
        GROUP BY 1, 2, 3""",
    "report_top_customers": """
        WITH revenue AS (
            SELECT customer_id, full_name, sum(gross_amount_azn) AS amount
            FROM fact JOIN dim_customer USING (customer_key) WHERE is_recognized GROUP BY 1, 2)
        SELECT customer_id, full_name, round(amount, 2)::DOUBLE AS recognized_revenue_azn,
               rank() OVER (ORDER BY amount DESC NULLS FIRST) AS revenue_rank,
               round(amount::DOUBLE * 100.0 / sum(amount) OVER ()::DOUBLE, 2) AS pct_of_total_revenue
        FROM revenue ORDER BY revenue_rank, customer_id, full_name LIMIT 10""",
    "report_funnel": """
        WITH reached AS (SELECT new_status, count(DISTINCT order_id) AS n FROM history GROUP BY 1),
        placed AS (
            SELECT stage, place, n, lag(n) OVER (ORDER BY place) AS base
            FROM (VALUES ('CREATED', 1), ('CONFIRMED', 2), ('PACKED', 3), ('SHIPPED', 4), ('DELIVERED', 5))
                 AS stages(stage, place) JOIN reached ON new_status = stage
            UNION ALL
            SELECT stage, NULL, coalesce((SELECT n FROM reached WHERE new_status = stage), 0),
                   (SELECT n FROM reached WHERE new_status = 'CREATED')
            FROM (VALUES ('CANCELLED'), ('REFUNDED')) AS lost(stage))
        SELECT stage, n AS orders_reached, ((n * 20000 + base) // (2 * base)) / 100.0 AS pct FROM placed""",
    "report_aov": f"""
        SELECT {_day("date_trunc('month', day)")} AS month,
               round(sum(total) / count(total), 2)::DOUBLE AS aov_azn, count(*) AS recognized_order_count
        FROM (SELECT order_id, strptime(min(order_date_key)::VARCHAR, '%Y%m%d')::DATE AS day,
                     bool_and(is_recognized) AS ok, sum(gross_amount_azn) AS total
              FROM fact GROUP BY order_id)
        WHERE ok AND day IS NOT NULL GROUP BY 1""",
    "report_lead_time": f"""
        SELECT {_day("date_trunc('month', delivered + INTERVAL 4 HOUR)")} AS month,
               round(quantile_cont(hours, 0.5), 1) AS p50_hours, round(quantile_cont(hours, 0.9), 1) AS p90_hours,
               count(*) AS delivered_order_count
        FROM (SELECT d.delivered, (epoch_us(d.delivered) - epoch_us(c.created)) / 3600000000.0 AS hours
              FROM (SELECT order_id, min(event_ts) AS created FROM history
                    WHERE new_status = 'CREATED' GROUP BY 1) c
              JOIN (SELECT order_id, min(event_ts) AS delivered FROM history
                    WHERE new_status = 'DELIVERED' GROUP BY 1) d USING (order_id))
        GROUP BY 1""",
    "dq_checks": """
        WITH results AS (
            SELECT 'bronze.orders' AS table_name, 'row_count' AS check_name, 0 AS failures
            UNION ALL SELECT 'bronze.orders', 'freshness__ingested_at', 1
            UNION ALL SELECT 'silver.order_lines', 'not_null_order_id', 0
            UNION ALL SELECT 'silver.order_lines', 'not_null_line_number', 0
            UNION ALL SELECT 'silver.order_lines', 'not_null_customer_id', count(*) FILTER (customer_id IS NULL) FROM lines
            UNION ALL SELECT 'silver.order_lines', 'not_null_product_id', 0
            UNION ALL SELECT 'silver.order_lines', 'not_null_currency', count(*) FILTER (currency IS NULL) FROM lines
            UNION ALL SELECT 'silver.order_lines', 'accepted_values_currency', count(*) FILTER (currency = 'AZM') FROM lines
            UNION ALL SELECT 'silver.products', 'not_null_product_id', 0
            UNION ALL SELECT 'silver.products', 'accepted_values_currency',
                count(*) FILTER (currency NOT IN ('AZN', 'USD', 'EUR', 'TRY'))
                FROM staged_products WHERE reason_code IS NULL
            UNION ALL SELECT 'silver.products', 'unique_product_id', count(*) - count(DISTINCT product_id)
                FROM staged_products WHERE reason_code IS NULL
            UNION ALL SELECT 'silver.order_lines', 'unique_order_id_line_number', count(*)
                FROM (SELECT 1 FROM lines GROUP BY order_id, line_number HAVING count(*) > 1)
            UNION ALL SELECT 'lineitem', 'unique_l_orderkey_l_linenumber', count(*)
                FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
            UNION ALL SELECT 'gold.dim_customer', 'not_null_customer_key', count(*) FILTER (customer_key IS NULL)
                FROM dim_customer
            UNION ALL SELECT 'gold.dim_customer', 'not_null_valid_to', count(*) FILTER (valid_to IS NULL)
                FROM dim_customer
            UNION ALL SELECT 'gold.fct_order_lines', 'relationship_product_id', count(*) FROM lines
                WHERE product_id NOT IN (SELECT product_id FROM dim_product)
            UNION ALL SELECT 'staging.order_lines', 'relationship_product_id', count(*) FROM staged_lines
                WHERE product_id NOT IN (SELECT product_id FROM dim_product)
            UNION ALL SELECT 'gold.fct_order_lines', 'grain',
                CASE WHEN (SELECT count(*) FROM fact) <> (SELECT count(*) FROM lines) THEN 1 ELSE 0 END
            UNION ALL SELECT 'gold.fct_order_lines', 'not_null_gross_amount_azn',
                count(*) FILTER (gross_amount_azn IS NULL) FROM fact)
        SELECT table_name, check_name, failures::BIGINT AS failures, failures = 0 AS passed FROM results""",
    "incremental_by_event": f"SELECT {STATUS_COLUMNS} FROM history WHERE {EVENT_LATE}",
    "incremental_keep_late": f"SELECT {STATUS_COLUMNS} FROM history",
    "incremental_by_order": f"""
        WITH batch AS (SELECT * FROM lines WHERE order_id IN (SELECT order_id FROM changed))
        SELECT {LINE_COLUMNS} FROM batch
        UNION ALL
        SELECT {LINE_COLUMNS} FROM early_staged e WHERE reason_code IS NULL AND NOT EXISTS (
            SELECT 1 FROM batch b WHERE b.order_id = e.order_id AND b.line_number = e.line_number)""",
    "incremental_rejected": """
        WITH rejects AS (
            SELECT md5(order_id || ':' || line_number || ':' || reason_code) AS id, * FROM staged_lines
            WHERE reason_code IS NOT NULL AND order_id IN (SELECT order_id FROM changed_rejects)),
        kept AS (
            SELECT md5(order_id || ':' || line_number || ':' || reason_code) AS id, * FROM early_staged
            WHERE reason_code IS NOT NULL)
        SELECT id AS quarantine_id, 'silver_order_lines' AS source, reason_code, order_id AS payload_order_id,
               product_id AS payload_product_id, 12::BIGINT AS payload_fields
        FROM (SELECT * FROM rejects UNION ALL SELECT * FROM kept WHERE id NOT IN (SELECT id FROM rejects))""",
    "incremental_fact": """
        SELECT order_id, line_number::BIGINT AS line_number, customer_key,
               gross_amount_azn::DOUBLE AS gross_amount_azn, final_status FROM fact""",
    "upsert_delete_insert": f"""
        SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, {_ts('o_orderdate')} AS o_orderdate
        FROM orders, (VALUES (1), (2)) AS twice(t) WHERE o_orderpriority = '1-URGENT'
        UNION ALL
        SELECT o_orderkey, o_custkey, o_orderstatus, {_ts('o_orderdate')} FROM orders
        WHERE o_orderpriority <> '1-URGENT' OR o_orderdate >= DATE '2000-01-01'""",
    "replace_range": f"""
        SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1998 THEN 'R' ELSE o_orderstatus END AS o_orderstatus,
               {_ts('o_orderdate')} AS o_orderdate, o_totalprice
        FROM orders WHERE year(o_orderdate) <> 1998 OR o_orderstatus = 'F'""",
    "reprocess_slice": f"""
        SELECT event_id, {_ts('ts')} AS ts,
               CASE WHEN event_type = 'view' AND ts::DATE IN (DATE '2024-01-10', DATE '2024-01-11') THEN 0.0
                    ELSE value END AS value,
               CASE WHEN event_type = 'view' THEN 'web' ELSE 'app' END AS _source FROM events""",
    "masked_customers": f"""
        SELECT customer_key, customer_id, sha256(full_name) AS full_name, country, segment,
               {_day("date_trunc('month', signup_date)")} AS signup_date, {_day('valid_from')} AS valid_from,
               {_day('valid_to')} AS valid_to, is_current FROM dim_customer""",
    "erase_subjects": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "src_order_pages": f"""
        SELECT order_id, {_ts('updated_at')} AS updated_at,
               CASE WHEN NOT without_items THEN product_id END AS first_product, 'record' AS kind
        FROM docs UNION ALL SELECT NULL, NULL, NULL, 'unreadable_page'""",
    "src_fx_documents": f"""
        WITH days AS (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY))::DATE AS day
                      FROM (SELECT o_orderdate::DATE + 9500 AS day FROM orders)),
        documents AS (SELECT DISTINCT rate_date AS day FROM rates)
        SELECT {_day('day')} AS day, true AS published FROM documents
        UNION ALL
        SELECT {_day('day')}, false FROM days ANTI JOIN documents USING (day) WHERE day < (SELECT max(day) FROM days)""",
    "erase_layers": """
        WITH gone AS (SELECT DISTINCT customer_id FROM custs WHERE regexp_matches(customer_id, '^C[0-9]*7$')),
        lost AS (SELECT DISTINCT order_id FROM docs WHERE customer_id IN (SELECT customer_id FROM gone)),
        erased_versions AS (SELECT customer_key FROM dim_customer WHERE customer_id IN (SELECT customer_id FROM gone))
        SELECT 'bronze.orders' AS table_name, 0::BIGINT AS naming_erased, count(*) AS row_count
        FROM docs WHERE customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM gone)
        UNION ALL SELECT 'bronze.customers', 0, count(*) FROM custs
                  WHERE customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM gone)
        UNION ALL SELECT 'quarantine.order_lines', 0, count(*) FROM staged_lines
                  WHERE reason_code IS NOT NULL AND (customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM gone))
        UNION ALL SELECT 'silver.order_lines', 0, count(*) FROM lines
                  WHERE customer_id NOT IN (SELECT customer_id FROM gone) AND order_id NOT IN (SELECT order_id FROM lost)
        UNION ALL SELECT 'gold.dim_customer', 0, count(*) FROM dim_customer
                  WHERE customer_id NOT IN (SELECT customer_id FROM gone)
        UNION ALL SELECT 'gold.fct_order_lines', 0, count(*) FROM fact
                  WHERE (customer_key IS NULL OR customer_key NOT IN (SELECT customer_key FROM erased_versions))
                    AND order_id NOT IN (SELECT order_id FROM lost)""",
    "src_customers_csv": """
        SELECT coalesce(customer_id, '') AS customer_id, full_name,
               ['azerbaijan', 'AZE', ' Azerbaijan ', 'TURKEY', 'Türkiye', 'N/A', 'Georgia', ''][c_nationkey % 8 + 1]
                   AS country, segment, strftime(signup_date, '%Y-%m-%d') AS signup_date,
               strftime(updated_at, '%Y-%m-%dT%H:%M:%SZ') AS updated_at,
               strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date FROM custs""",
    "src_products_csv": """
        SELECT product_id, product_name,
               CASE p_partkey % 31 WHEN 5 THEN '  ' WHEN 6 THEN '' ELSE p_type END AS category,
               CASE WHEN p_partkey % 37 = 4 THEN '-5.00' WHEN p_partkey % 41 = 6 THEN ''
                    ELSE format('{:,.2f}', p_retailprice) END AS unit_price,
               CASE WHEN p_partkey % 43 = 7 THEN 'AZM'
                    ELSE ['azn', ' USD', 'EUR', 'Try '][p_partkey % 4 + 1] END AS currency,
               strftime(updated_at, '%Y-%m-%dT%H:%M:%SZ') AS updated_at
        FROM prods JOIN part USING (p_partkey)""",
    "src_optional": "SELECT n_name AS value FROM nation",
    "src_event_lines": """
        SELECT count(*) + count(*) FILTER (event_id % 50 = 7) + count(*) FILTER (event_id % 211 = 3)
               + count(*) FILTER (event_id % 211 = 3 AND event_id % 50 = 7) AS line_count, true AS numbered
        FROM events""",
    "ndjson_split": """
        WITH written AS (
            SELECT e.op FROM event_docs e
            UNION ALL SELECT CASE WHEN event_id % 211 = 3 THEN 'd' WHEN event_type = 'view' THEN 'c' ELSE 'u' END
            FROM events WHERE event_id % 50 = 7)
        SELECT 'event' AS kind, op, count(*) AS row_count FROM written GROUP BY 2
        UNION ALL SELECT 'quarantine', NULL, count(*) FROM written WHERE op = 'd' HAVING count(*) > 0""",
    "audit_columns": """
        SELECT count(*) AS row_count, count(*) AS record_ids, 1::BIGINT AS batches, 'orders_api' AS source,
               'orders_1995-01-01_2002-01-01' AS load_id FROM orders""",
    "replace_load": """
        SELECT 'customers_' || strftime(snapshot_date, '%Y-%m-%d') AS _load_id,
               CASE WHEN n = 2 THEN 'NEW' ELSE segment END AS segment, count(*) AS row_count
        FROM custs GROUP BY ALL""",
    "stream_accounting": """
        SELECT count(*) AS landed, true AS all_accounted, true AS repeats_not_negative FROM event_docs""",
    "partition_layout": """
        SELECT strftime(o_orderdate, '%Y-%m') AS order_month, count(*) AS row_count FROM orders GROUP BY 1""",
    "compact": """
        SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS row_count, sum(event_id)::BIGINT AS ids
        FROM events GROUP BY 1""",
    "export_csv": "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY 1",
    "medallion_run": """
        SELECT 'bronze.orders' AS table_name, count(*) AS row_count, 0::DOUBLE AS value_sum FROM docs
        UNION ALL SELECT 'bronze.customers', count(*), 0 FROM custs
        UNION ALL SELECT 'bronze.products', count(*), 0 FROM prods
        UNION ALL SELECT 'bronze.events', count(*) + count(*) FILTER (event_id % 50 = 7), 0 FROM events
        UNION ALL SELECT 'silver.order_lines', count(*), sum(quantity * line_number) FROM lines
        UNION ALL SELECT 'quarantine.order_lines', count(*), sum(length(reason_code))
                  FROM staged_lines WHERE reason_code IS NOT NULL
        UNION ALL SELECT 'silver.customers', count(*), 0 FROM snapshots
        UNION ALL SELECT 'quarantine.customers', count(*), 0 FROM staged_customers WHERE reason_code IS NOT NULL
        UNION ALL SELECT 'silver.products', count(*), 0 FROM staged_products WHERE reason_code IS NULL
        UNION ALL SELECT 'quarantine.products', count(*), 0 FROM staged_products WHERE reason_code IS NOT NULL
        UNION ALL SELECT 'silver.order_status_history', count(*), sum(length(new_status)) FROM history
        UNION ALL SELECT 'quarantine.order_events', count(*), sum(length(reason_code))
                  FROM staged_events WHERE reason_code IS NOT NULL
        UNION ALL SELECT 'silver.order_status_reconciliation', count(*),
                         sum(length(final_status || reconciliation_status)) FROM reconciled
        UNION ALL SELECT 'gold.dim_customer', count(*), sum(length(segment)) FROM dim_customer
        UNION ALL SELECT 'gold.dim_product', count(*), 0 FROM dim_product
        UNION ALL SELECT 'gold.fct_order_lines', count(*), round(sum(gross_amount_azn), 2)::DOUBLE FROM fact
        UNION ALL SELECT 'gold.fct_order_status_events', count(*),
                         sum(strftime((event_ts + INTERVAL 4 HOUR)::DATE, '%Y%m%d')::BIGINT) FROM history""",
    "asof_fx_hot": f"""
        WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN 'USD' ELSE 'EUR' END AS currency,
                          make_timestamp(CASE WHEN o_orderkey % 10 <> 0
                                              THEN 1709251200000000 + o_orderkey * 7919 * 1000003 % 2678400000000
                                              ELSE (date_diff('day', DATE '1970-01-01', o_orderdate::DATE) + 9500) * 86400000000 END) AS at
                   FROM orders),
        slots AS (SELECT currency, rate_date::TIMESTAMP + to_hours((slot * 4)::INTEGER) AS since, rate_azn + slot AS rate
                  FROM rates, (VALUES (0), (1), (2), (3), (4), (5)) AS s(slot))
        SELECT o_orderkey, o.currency, {_ts('o.at')} AS at, rate::DOUBLE AS rate
        FROM o ASOF LEFT JOIN slots ON o.currency = slots.currency AND o.at >= since""",
    "dim_customer_merge": f"SELECT {DIM_COLUMNS} FROM dim_customer",
    "erased_lake": """
        WITH gone AS (SELECT DISTINCT customer_id FROM custs WHERE regexp_matches(customer_id, '^C[0-9]*7$')),
        lost AS (SELECT DISTINCT order_id FROM docs WHERE customer_id IN (SELECT customer_id FROM gone)),
        erased AS (SELECT customer_key FROM dim_customer WHERE customer_id IN (SELECT customer_id FROM gone))
        SELECT 'bronze.orders' AS table_name, count(*) AS row_count, 0::BIGINT AS rows_left FROM docs WHERE order_id NOT IN (SELECT order_id FROM lost)
        UNION ALL SELECT 'bronze.events', count(*) + count(*) FILTER (event_id % 50 = 7), NULL
                  FROM (SELECT e.event_id, 'O' || (event_id // 5) || '-' || (event_id // 5 % 7 + 1) AS order_id FROM events e) WHERE order_id NOT IN (SELECT order_id FROM lost)
        UNION ALL SELECT 'bronze.customers', count(*), 0 FROM custs WHERE customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM gone)
        UNION ALL SELECT 'silver.order_lines', count(*), 0 FROM lines WHERE order_id NOT IN (SELECT order_id FROM lost)
        UNION ALL SELECT 'quarantine.order_lines', count(*), 0 FROM staged_lines WHERE reason_code IS NOT NULL AND order_id NOT IN (SELECT order_id FROM lost)
        UNION ALL SELECT 'silver.order_status_history', count(*), NULL FROM history WHERE order_id NOT IN (SELECT order_id FROM lost)
        UNION ALL SELECT 'quarantine.order_events', count(*), NULL FROM staged_events WHERE reason_code IS NOT NULL AND order_id NOT IN (SELECT order_id FROM lost)
        UNION ALL SELECT 'silver.order_status_reconciliation', count(*), NULL FROM reconciled WHERE order_id NOT IN (SELECT order_id FROM lost)
        UNION ALL SELECT 'gold.dim_customer', count(*), 0 FROM dim_customer WHERE customer_id NOT IN (SELECT customer_id FROM gone)
        UNION ALL SELECT 'gold.fct_order_lines', count(*), NULL FROM fact WHERE order_id NOT IN (SELECT order_id FROM lost)
        UNION ALL SELECT 'gold.fct_order_status_events', count(*), NULL FROM history WHERE order_id NOT IN (SELECT order_id FROM lost)""",
    "stray_rows": """
        SELECT strftime(updated_at, '%Y-%m') AS month, count(*) AS row_count, 0 AS misplaced FROM docs GROUP BY 1""",
    "partition_plan": """
        WITH days AS (SELECT strftime(updated_at, '%Y-%m-%d') AS day, count(*) AS n FROM docs GROUP BY 1),
        sized AS (SELECT *, coalesce(sum(n) FILTER (n <= target) OVER (PARTITION BY target, left(day, 7)), 0) AS light
                  FROM days, (VALUES (20), (600), (50000)) AS t(target))
        SELECT day, CASE WHEN n <= target AND light <= target THEN left(day, 7) ELSE day END AS label,
               CASE WHEN n <= target THEN 1 ELSE least(1024, pow(2, ceil(log2(n / target)))) END::BIGINT AS splits, n, target FROM sized""",
    "day_partitions": """
        SELECT strftime(updated_at, '%Y-%m-%d') AS day, count(*) AS row_count,
               strftime(updated_at, '%Y-%m-%d') = '2025-03-11'
               OR bool_or(strftime(updated_at, '%Y-%m-%d') = '2025-03-20' AND order_id LIKE '%-1') AS rewritten
        FROM docs WHERE updated_at >= DATE '2025-03-01' AND updated_at < DATE '2025-03-22' GROUP BY 1""",
    "order_places": """
        SELECT DISTINCT order_id, strftime(updated_at, '%Y-%m') AS part FROM docs""",
    "moved_events": """
        SELECT CASE WHEN substr(event_id, 2)::BIGINT % 6 = 1 THEN 'corrected' ELSE 'order-service' END AS source,
               count(*) AS row_count, count(DISTINCT event_id) AS ids FROM history GROUP BY 1""",
    "version_diff": """
        WITH old AS (SELECT o_orderkey, o_custkey || '|' || o_totalprice::VARCHAR AS content FROM orders),
        new AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 4 THEN o_custkey || '|0' ELSE o_custkey || '|' || o_totalprice::VARCHAR END AS content
                FROM orders WHERE o_orderkey % 7 <> 3
                UNION ALL SELECT * FROM old WHERE o_orderkey % 13 = 5
                UNION ALL SELECT -o_orderkey, content FROM old WHERE o_orderkey % 17 = 1),
        sides AS (SELECT *, 1 AS o, 0 AS n FROM old UNION ALL SELECT *, 0, 1 FROM new)
        SELECT o_orderkey, content, sum(o)::BIGINT AS n_old, sum(n)::BIGINT AS n_new,
               CASE WHEN sum(o) = 0 THEN 'added' WHEN sum(n) = 0 THEN 'removed' ELSE 'recounted' END AS change
        FROM sides GROUP BY 1, 2 HAVING sum(o) <> sum(n)""",
    "interval_partitions": """
        SELECT DISTINCT 'bronze.orders' AS table_name, strftime(updated_at, '%Y-%m') AS partition
        FROM docs WHERE updated_at >= DATE '2025-06-01'
        UNION ALL SELECT DISTINCT 'bronze.fx_rates', strftime(rate_date, '%Y-%m') FROM rates
                  WHERE rate_date >= DATE '2025-06-01'""",
    "stream_events": f"SELECT {STATUS_COLUMNS} FROM event_docs",
    "stream_latest_status": f"""
        SELECT order_id, op, new_status, {_ts('event_ts')} AS event_ts FROM event_docs
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY event_ts DESC) = 1""",
}


SQL["rerun_interval"] = SQL["medallion_run"]
SQL["revenue_after_runs"] = SQL["report_monthly_revenue"]


def _needed(sql: str) -> set[str]:
    """Parts a statement mentions, and the parts those mention."""
    found = {name for name in PARTS if re.search(rf"\b{name}\b", sql)}
    return found.union(*[_needed(PARTS[name]) - {name} for name in found]) if found else found


def statements() -> dict[str, str]:
    complete = {}
    for key, sql in SQL.items():
        needed = _needed(sql)
        parts = ",\n".join(f"{name} AS ({body.strip()})" for name, body in PARTS.items() if name in needed)
        body = sql.strip()
        if parts and body.startswith("WITH "):
            complete[key] = f"WITH {parts},\n{body[5:]}"
        else:
            complete[key] = f"WITH {parts}\n{body}" if parts else body
    return complete
