"""The results of ``queries.py`` in SQL that DuckDB runs on the same tables."""

from __future__ import annotations

_EVOLVING = """
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status,
  NULL::BIGINT AS customer_id, NULL AS priority, 'batch_1' AS _batch_id FROM orders WHERE year(o_orderdate) % 3 = 1993 % 3
UNION ALL SELECT o_orderkey, CAST(o_orderdate AS DATE), o_orderstatus, o_custkey, NULL, 'batch_2'
FROM orders WHERE year(o_orderdate) % 3 = 1994 % 3
UNION ALL SELECT o_orderkey, NULL, NULL, NULL, o_orderpriority, 'batch_3'
FROM orders WHERE year(o_orderdate) % 3 = 1995 % 3"""

_RANGES = """
WITH parts AS (
  SELECT p_partkey, p_partkey % 1000 = 0 AND p_size IS NOT NULL AS raised, p_partkey % 777 = 0 AS lost FROM part
),
checked AS (
  SELECT p_partkey, CASE WHEN raised THEN 2 ELSE 1 END::BIGINT AS distinct_hashes,
    CASE WHEN lost THEN 2 ELSE 3 END::BIGINT AS variant_count,
    CASE WHEN raised OR lost THEN 'FAIL' ELSE 'PASS' END AS status
  FROM parts
)
"""

# --- shared subqueries -------------------------------------------------------------------

_STATES = """
batches(batch_id, effective) AS (VALUES ('batch_1', DATE '1995-01-01'), ('batch_2', DATE '1998-01-01')),
states AS (
  SELECT c_custkey AS customer_id,
    CASE WHEN batch_id = 'batch_2' AND c_acctbal >= 2500 AND c_acctbal < 4000
         THEN c_name || ' Jr' ELSE c_name END AS customer_name,
    lower(c_name) || '@example.com' AS email,
    'Street ' || c_nationkey AS address,
    CASE WHEN batch_id = 'batch_2' AND c_acctbal < 2500
         THEN 'Elsewhere' ELSE 'City ' || c_nationkey END AS city,
    upper(n_name) AS country,
    upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS segment,
    batch_id, effective
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN batches ON (batch_id = 'batch_1' AND c_mktsegment <> 'BUILDING')
               OR (batch_id = 'batch_2' AND c_mktsegment <> 'AUTOMOBILE')
)"""

# Versions of customers: a state starts one if it is the first or differs from the state before.
_VERSIONS = (
    _STATES
    + """,
marked AS (
  SELECT *, lag(email || address || city || country || segment)
      OVER (PARTITION BY customer_id ORDER BY effective) AS before
  FROM states
),
versions AS (
  SELECT customer_id, customer_name, email, address, city, country, segment, effective,
    lead(effective) OVER (PARTITION BY customer_id ORDER BY effective) AS next_start
  FROM marked
  WHERE before IS NULL OR before <> email || address || city || country || segment
),
closed AS (
  SELECT customer_id, customer_name, email, address, city, country, segment,
    effective AS valid_from,
    CASE WHEN next_start IS NULL THEN DATE '9999-12-31'
         ELSE CAST(next_start - INTERVAL 1 DAY AS DATE) END AS valid_to,
    next_start IS NULL AS is_current
  FROM versions
),
dim_customer AS (
  SELECT row_number() OVER (ORDER BY customer_id, valid_from) AS customer_sk, * FROM closed
)"""
)

_LINES = """
typed_lines AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_id, l_partkey AS product_id,
    CAST(l_quantity AS INTEGER) AS quantity,
    CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price,
    CAST(CAST(l_discount AS DECIMAL(5,2)) * 100 AS DECIMAL(5,2)) AS discount_pct,
    year(l_shipdate) - 1994 AS batch
  FROM lineitem
),
amounts AS (
  SELECT *, CAST(round(CAST(quantity AS DECIMAL(10,0)) * unit_price
      * (CAST(100 AS DECIMAL(5,2)) - discount_pct) * CAST(0.01 AS DECIMAL(3,2)), 2)
      AS DECIMAL(12,2)) AS line_amount
  FROM typed_lines
),
lines AS (
  SELECT * EXCLUDE (batch, place) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, line_id
        ORDER BY batch DESC, product_id DESC, quantity DESC, unit_price DESC, discount_pct DESC) AS place
    FROM amounts)
  WHERE place = 1
)"""

_ORDERS = """
clean_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'completed' ELSE lower(o_orderstatus) END AS status
  FROM orders
)"""

_PRODUCTS = """
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS category,
    p_type AS subcategory, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price
  FROM part
),
dim_product AS (
  SELECT row_number() OVER (ORDER BY product_id) AS product_sk, * FROM products
)"""

_FACT = (
    ",".join([_VERSIONS, _LINES, _ORDERS, _PRODUCTS])
    + """,
fact AS (
  SELECT row_number() OVER (ORDER BY l.order_id, l.line_id) AS order_line_sk,
    l.order_id, l.line_id, c.customer_sk, p.product_sk,
    CAST(strftime(o.order_date, '%Y%m%d') AS INTEGER) AS order_date_key,
    l.quantity, l.unit_price, l.discount_pct, l.line_amount, o.status AS order_status
  FROM lines l JOIN clean_orders o ON l.order_id = o.order_id
  LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
    AND o.order_date BETWEEN c.valid_from AND c.valid_to
  LEFT JOIN dim_product p ON l.product_id = p.product_id
)"""
)

_DATES = """
span AS (
  SELECT date_trunc('month', min(o_orderdate)) AS a, last_day(CAST(max(o_orderdate) AS DATE)) AS z
  FROM orders
),
calendar AS (
  SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
    AS full_date FROM span
),
dates AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
    CAST(year(full_date) AS INTEGER) AS year, CAST(quarter(full_date) AS INTEGER) AS quarter,
    CAST(month(full_date) AS INTEGER) AS month, monthname(full_date) AS month_name,
    CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week, dayname(full_date) AS day_name,
    dayofweek(full_date) IN (0, 6) AS is_weekend
  FROM calendar
)"""

_GAPS = """
gaps AS (
  SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
    CASE WHEN NOT (event_type = 'click' AND value < 1) THEN event_type END AS event_type, value
  FROM events
)"""

_EVENT_RUNS = """
marked AS (
  SELECT *, event_type IS DISTINCT FROM lag(event_type) OVER w AS starts,
    coalesce(event_type IS DISTINCT FROM lead(event_type) OVER w, TRUE) AS ends
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
),
numbered AS (
  SELECT *, sum(CAST(starts AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id
      ROWS UNBOUNDED PRECEDING) AS run
  FROM marked
),
runs AS (
  SELECT user_id, run, min(event_type) AS event_type, min(ts) AS start_at,
    arg_min(value, event_id) AS first_value, arg_min(event_id, event_id) AS first_id,
    arg_max(value, event_id) AS last_value, arg_max(event_id, event_id) AS last_id
  FROM numbered GROUP BY user_id, run
),
history AS (
  SELECT *, lead(start_at) OVER (PARTITION BY user_id ORDER BY start_at) AS end_at FROM runs
)"""

_COUNTS = (
    ",".join([_STATES])
    + """,
counts AS (
  SELECT 'all' AS variant, 'customers' AS table_name, count(*) AS row_count FROM states
  UNION ALL SELECT 'all', 'products', count(*) FROM part
  UNION ALL SELECT 'all', 'orders',
    count(*) + count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) FROM orders
  UNION ALL SELECT 'cleaned', 'customers', count(DISTINCT customer_id) FROM states
  UNION ALL SELECT 'cleaned', 'products', count(*) FROM part
  UNION ALL SELECT 'cleaned', 'orders', count(*) FROM orders
  UNION ALL SELECT 'cleaned', 'nothing', 0
),
expected AS (
  SELECT 'customers' AS table_name, count(*) AS expected_rows FROM customer
  UNION ALL SELECT 'products', count(*) FROM part
  UNION ALL SELECT 'orders', count(*) FROM orders
),
checked AS (
  SELECT c.table_name, variant, expected_rows, row_count,
    CASE WHEN row_count = expected_rows THEN 'PASS' ELSE 'FAIL' END AS status
  FROM counts c JOIN expected e ON c.table_name = e.table_name
)"""
)


def _with(parts: str, select: str) -> str:
    return f"WITH {parts} {select}"


_EVENT_COLUMNS = "user_id, ts, event_id, event_type, value"
_LATEST_EVENT = f"""SELECT {_EVENT_COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
  FROM events) WHERE place = 1"""

_BATCH_ORDERS = _with(
    "b(batch_id) AS (VALUES ('batch_1'), ('batch_2'))",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CAST(o_orderdate AS DATE) AS order_date,
    CASE WHEN batch_id = 'batch_2' THEN 'completed' ELSE lower(o_orderstatus) END AS status,
    batch_id AS _batch_id
  FROM orders JOIN b ON batch_id = 'batch_1' OR o_orderpriority = '1-URGENT'""",
)

_FACT_ROWS = _with(_FACT, "SELECT * FROM fact")
_DIM_CUSTOMER = _with(_VERSIONS, "SELECT * FROM dim_customer")

_EVENT_LATEST = _with(
    _EVENT_RUNS,
    """SELECT user_id, last_value AS value, last_id AS event_id, event_type,
    start_at AS __START_AT, end_at AS __END_AT FROM history""",
)

_BAND = """
source AS (
  SELECT user_id, ts, event_id, CAST(floor(value / 10) AS INTEGER) AS band FROM events
),
changes AS (
  SELECT * FROM (
    SELECT *, lag(band) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM source)
  WHERE band IS DISTINCT FROM before
)"""
_BAND_AT = _with(
    _BAND,
    """SELECT e.event_id, e.user_id, e.ts, c.band
  FROM events e ASOF LEFT JOIN changes c ON e.user_id = c.user_id AND e.ts >= c.ts""",
)


# The last event of each user and day, as versions in days.
_DAILY = """
daily AS (
  SELECT user_id, CAST(ts AS DATE) AS day, arg_max(event_type, event_id) AS event_type
  FROM events GROUP BY user_id, CAST(ts AS DATE)
),
changed AS (
  SELECT * FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY day) AS before
    FROM daily) WHERE event_type IS DISTINCT FROM before
),
ended AS (SELECT *, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS nxt FROM changed),
kinds AS (
  SELECT user_id, event_type, day AS valid_from,
    coalesce(CAST(nxt - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS valid_to,
    nxt IS NULL AS is_current FROM ended
)"""
_KIND_OF_DAY = _with(
    _DAILY,
    """SELECT e.event_id, e.user_id, CAST(e.ts AS DATE) AS day, k.event_type AS kind
  FROM events e LEFT JOIN kinds k ON e.user_id = k.user_id
    AND CAST(e.ts AS DATE) BETWEEN k.valid_from AND k.valid_to""",
)

# Tests that are declared and pass: table, test, column.
_PASSING = [
    *[(f"bronze_{e}", "not_null", c) for e, keys in {
        "customers": ["customer_id"], "products": ["product_id"], "orders": ["order_id"],
        "order_lines": ["order_id", "line_id"],
    }.items() for c in [*keys, "_batch_id"]],
    *[(f"bronze_{e}", "accepted_values", "_batch_id")
      for e in ("customers", "products", "orders", "order_lines")],
    *[(f"silver_{e}", "not_null", c) for e, keys in {
        "customers": ["customer_id"], "products": ["product_id"], "orders": ["order_id"],
        "order_lines": ["order_id", "line_id"],
    }.items() for c in keys],
    ("silver_customers", "unique", "customer_id"),
    ("silver_products", "unique", "product_id"),
    ("silver_orders", "unique", "order_id"),
    ("silver_order_lines", "unique", "order_id, line_id"),
    ("dim_customer", "not_null", "customer_sk"),
    ("dim_customer", "not_null", "customer_id"),
    ("dim_customer", "unique", "customer_sk"),
    ("dim_product", "not_null", "product_sk"),
    ("dim_product", "not_null", "product_id"),
    ("dim_product", "unique", "product_sk"),
    ("dim_product", "unique", "product_id"),
    ("dim_date", "not_null", "date_key"),
    ("dim_date", "unique", "date_key"),
    ("fact_order_line", "not_null", "order_line_sk"),
    ("fact_order_line", "not_null", "product_sk"),
    ("fact_order_line", "not_null", "order_date_key"),
    ("fact_order_line", "unique", "order_line_sk"),
    ("fact_order_line", "relationships", "customer_sk"),
    ("fact_order_line", "relationships", "product_sk"),
    ("fact_order_line", "relationships", "order_date_key"),
]

ORACLE: dict[str, str] = {
    "standardize_customers": _with(
        _STATES, "SELECT * EXCLUDE (effective, batch_id), batch_id AS _batch_id FROM states"
    ),
    "standardize_parts": _with(_PRODUCTS, "SELECT * FROM products"),
    "standardize_orders": _BATCH_ORDERS,
    "line_amounts": _with(
        _LINES, "SELECT * EXCLUDE (batch), 'batch_' || batch AS _batch_id FROM amounts"
    ),
    "unreadable_values": """SELECT event_type,
          CASE WHEN event_type = 'view' THEN ' ' ELSE 'no. ' END || event_id AS text,
          CASE WHEN event_type = 'view' THEN event_id END AS number FROM events""",
    "unreadable_measures": """WITH n AS (
          SELECT count(*) AS seen, count(CASE WHEN l_linenumber = 3 THEN 1 END) AS quantity,
            count(CASE WHEN l_linenumber = 4 THEN 1 END) AS price,
            count(CASE WHEN l_linenumber = 5 AND l_discount < 0.999 THEN 1 END) AS amount
          FROM lineitem)
        SELECT r.rule, seen AS rows_seen, seen - r.dropped AS rows_kept, r.dropped FROM n,
          LATERAL (VALUES ('readable_product_id', 0), ('readable_quantity', quantity),
            ('readable_unit_price', price), ('readable_discount_pct', 0),
            ('amount_fits', amount)) AS r(rule, dropped)""",
    "select_batch": _with(
        _LINES, "SELECT order_id, line_id, product_id, line_amount FROM amounts WHERE batch = 3"
    ),
    "latest_wins_lines": _with(_LINES, "SELECT * FROM lines"),
    "latest_wins_events": _LATEST_EVENT,
    "latest_wins_events_aggregated": _LATEST_EVENT,
    "latest_wins_correction": _with(_ORDERS, "SELECT * FROM clean_orders"),
    "reject_null_keys": _with(
        _GAPS, "SELECT * FROM gaps WHERE user_id IS NOT NULL AND event_type IS NOT NULL"
    ),
    "expectation_counts": _with(
        _GAPS,
        """SELECT * FROM (WITH t AS (SELECT count(*) AS n, count(user_id) AS u, count(event_type) AS e,
            count(CASE WHEN value < 100 THEN 1 END) AS v FROM gaps)
        SELECT 'valid_user' AS rule, n AS rows_seen, u AS rows_kept, n - u AS dropped FROM t
        UNION ALL SELECT 'known_type', n, e, n - e FROM t
        UNION ALL SELECT 'small_value', n, v, n - v FROM t)""",
    ),
    "quarantine_rejects": _with(
        _GAPS,
        """SELECT event_id, user_id, concat_ws(',',
            CASE WHEN user_id IS NULL THEN 'valid_user' END,
            CASE WHEN event_type IS NULL THEN 'known_type' END,
            CASE WHEN NOT coalesce(value < 100, FALSE) THEN 'small_value' END) AS failed_rules
        FROM gaps WHERE user_id IS NULL OR event_type IS NULL OR NOT coalesce(value < 100, FALSE)""",
    ),
    "dim_product": _with(_PRODUCTS, "SELECT * FROM dim_product"),
    "dim_date_orders": _with(_DATES, "SELECT * FROM dates"),
    "scd1_customers": _with(
        _STATES,
        """SELECT row_number() OVER (ORDER BY customer_id) AS customer_sk, customer_id,
            customer_name, email, address, city, country, segment, batch_id AS _batch_id
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY batch_id DESC) AS place
              FROM states) WHERE place = 1""",
    ),
    "surrogate_keys_lines": """SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS line_sk,
        l_orderkey, l_linenumber FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""",
    "surrogate_keys_text": """SELECT row_number() OVER (ORDER BY p_name, p_brand, p_type) AS name_sk,
        p_name, p_brand, p_type FROM (SELECT DISTINCT p_name, p_brand, p_type FROM part)""",
    "dim_customer_compare": _DIM_CUSTOMER,
    "dim_customer_fold": _DIM_CUSTOMER,
    "star_by_snapshot_run": _DIM_CUSTOMER,
    "dim_customer_history": _with(
        _VERSIONS,
        """SELECT row_number() OVER (ORDER BY customer_id, effective) AS customer_sk,
            customer_id, customer_name, email, address, city, country, segment,
            effective AS __START_AT, next_start AS __END_AT FROM versions""",
    ),
    "history_ends_by_next": _with(
        _STATES,
        """SELECT customer_id, city, segment, effective AS valid_from,
            coalesce(CAST(nxt - INTERVAL 1 DAY AS DATE), DATE '9999-12-31') AS valid_to,
            nxt IS NULL AS is_current
        FROM (SELECT *, lead(effective) OVER (PARTITION BY customer_id ORDER BY effective) AS nxt
              FROM states)""",
    ),
    "history_normalised": _with(_VERSIONS, "SELECT * FROM closed"),
    "history_half_open_again": _with(
        _VERSIONS,
        """SELECT customer_id, customer_name, email, address, city, country, segment,
            effective AS __START_AT, next_start AS __END_AT FROM versions""",
    ),
    "event_type_history": _with(
        _EVENT_RUNS,
        "SELECT user_id, event_type, start_at AS __START_AT, end_at AS __END_AT FROM history",
    ),
    "event_history_first_policy": _with(
        _EVENT_RUNS,
        """SELECT user_id, first_value AS value, first_id AS event_id, event_type,
            start_at AS __START_AT, end_at AS __END_AT FROM history""",
    ),
    "event_history_latest_policy": _EVENT_LATEST,
    "event_history_hot_users": _EVENT_LATEST,
    "cdc_apply_compacted": _EVENT_LATEST,
    "cdc_apply_stream": _EVENT_LATEST,
    "cdc_apply_stream_replayed": _EVENT_LATEST,
    "event_daily_state": _with(_DAILY, "SELECT * FROM kinds"),
    "event_history_closed_from_times": _with(_DAILY, "SELECT * FROM kinds"),
    "fact_closed": _FACT_ROWS,
    "fact_half_open": _FACT_ROWS,
    "fact_bucketed": _FACT_ROWS,
    "append_compacted": "SELECT o_orderkey, o_custkey FROM orders",
    "fact_without_broadcast": _FACT_ROWS,
    "star_by_batch_run": _FACT_ROWS,
    "star_by_incremental_run": _FACT_ROWS,
    "star_by_arrivals": _FACT_ROWS,
    "dim_customer_same_date": _with(
        _STATES,
        """SELECT method, customer_id, customer_name, email, address, city, country, segment,
            DATE '1995-01-01' AS valid_from, DATE '9999-12-31' AS valid_to, true AS is_current
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY batch_id DESC) AS place FROM states),
             (VALUES ('history'), ('stream'), ('snapshots'), ('compare')) AS m(method)
        WHERE place = 1""",
    ),
    "fact_unmatched": _with(
        _VERSIONS + "," + _ORDERS,
        """SELECT CAST(year(order_date) AS INTEGER) AS order_year, count(*) AS orders,
            count(CASE WHEN customer_sk IS NULL THEN 1 END) AS unmatched
        FROM clean_orders o LEFT JOIN dim_customer c ON o.customer_id = c.customer_id
          AND o.order_date BETWEEN c.valid_from AND c.valid_to
        GROUP BY year(order_date)""",
    ),
    "lookup_long_history": _BAND_AT,
    "lookup_long_history_hot_users": _BAND_AT,
    "lookup_salted": """SELECT l_orderkey, l_linenumber, s_name, n_name AS nation
        FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
        LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "lookup_same_day_changes": _KIND_OF_DAY,
    "lookup_same_day_changes_without_broadcast": _KIND_OF_DAY,
    "lookup_same_day_changes_hot_users": _KIND_OF_DAY,
    "row_count_report": """SELECT count(*) AS reported, count(*) AS stored FROM (
          SELECT o_orderkey FROM orders
          UNION ALL SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "latest_wins_long_batch_numbers": """SELECT o_orderkey, 'batch_20240301120000' AS batch
        FROM orders""",
    "load_evolving_files": _EVOLVING,
    "load_evolving_files_forced": _EVOLVING,
    "lineage_columns": """SELECT o_orderkey AS order_id, 'batch_1' AS _batch_id,
          true AS from_file, true AS timed FROM orders
        UNION ALL SELECT o_orderkey, 'batch_2', true, true FROM orders
        WHERE o_orderpriority = '1-URGENT'""",
    "catalog_reload": "SELECT p_partkey, p_name FROM part",
    "catalog_replace": "SELECT p_partkey, p_brand FROM part",
    "catalog_truncate": """SELECT n_nationkey, n_name, 0 AS left_after_truncate
        FROM nation WHERE n_nationkey < 10""",
    "refresh_read_between": """
        SELECT 1 AS version, count(*) AS parts, sum(p_partkey)::BIGINT AS keys FROM part
        UNION ALL SELECT 2, count(*), sum(p_partkey)::BIGINT FROM part WHERE p_size <= 25""",
    "dim_customer_by_stream": _with(
        _VERSIONS, "SELECT * EXCLUDE (customer_name) FROM dim_customer"
    ),
    "dq_not_null": _with(
        _GAPS,
        """SELECT 'events' AS table_name, 'not_null' AS test, 'event_id' AS column_name,
            count(*) - count(event_id) AS failures FROM gaps
        UNION ALL SELECT 'events', 'not_null', 'user_id', count(*) - count(user_id) FROM gaps
        UNION ALL SELECT 'events', 'not_null', 'event_type', count(*) - count(event_type) FROM gaps""",
    ),
    "dq_accepted": """SELECT 'orders' AS table_name, 'accepted_values' AS test,
          'o_orderstatus' AS column_name, count(*) AS failures
        FROM orders WHERE o_orderstatus NOT IN ('O', 'F')
        UNION ALL SELECT 'orders', 'accepted_values', 'o_orderpriority', count(*)
        FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW')""",
    "dq_unique": """WITH f AS (
          SELECT 'lineitem' AS table_name, 'unique' AS test, 'l_orderkey, l_linenumber' AS column_name,
            (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber
                                   HAVING count(*) > 1)) AS failures
          UNION ALL SELECT 'orders', 'unique', 'o_orderkey',
            (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)))
        SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM f""",
    "dq_relationships": """WITH f AS (
          SELECT 'lineitem' AS table_name, 'relationships' AS test, 'l_orderkey' AS column_name,
            (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))
              AS failures
          UNION ALL SELECT 'lineitem to non-urgent', 'relationships', 'l_orderkey',
            (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN
              (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '1-URGENT')))
        SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM f""",
    "row_count_matrix": _with(_COUNTS, "SELECT * FROM counts"),
    "count_check": _with(_COUNTS, "SELECT * FROM checked"),
    "reconcile_summary": _with(
        _COUNTS,
        """SELECT table_name, expected_rows,
            count(CASE WHEN status = 'PASS' THEN 1 END) AS variants_passing,
            count(*) AS total_variants,
            CASE WHEN bool_and(status = 'PASS') THEN 'ALL PASS' ELSE 'SOME FAIL' END AS overall_status,
            coalesce(string_agg(CASE WHEN status = 'FAIL' THEN variant || '=' || row_count END, ', '
                ORDER BY variant), '') AS failing_variants
        FROM checked GROUP BY table_name, expected_rows""",
    ),
    "content_check_product": _with(
        _PRODUCTS,
        """SELECT product_id,
            CASE WHEN subcategory <> 'SMALL' AND category = 'Brand#1' THEN 2 ELSE 1 END::BIGINT
              AS distinct_hashes,
            CASE WHEN subcategory <> 'SMALL' THEN 2 ELSE 1 END::BIGINT AS variant_count,
            CASE WHEN subcategory <> 'SMALL' AND category <> 'Brand#1' THEN 'PASS' ELSE 'FAIL' END
              AS status
        FROM products""",
    ),
    "content_check_customer": _with(
        _VERSIONS,
        """SELECT customer_id, valid_from, 1::BIGINT AS distinct_hashes, 2::BIGINT AS variant_count,
            'PASS' AS status FROM closed""",
    ),
    "content_check_date": _with(
        _DATES,
        """SELECT date_key, 2::BIGINT AS distinct_hashes, 2::BIGINT AS variant_count,
            'FAIL' AS status FROM dates WHERE day_name = 'Friday'""",
    ),
    "content_check_fact": _with(
        _LINES + "," + _ORDERS,
        """SELECT l.order_id, line_id, 1::BIGINT AS distinct_hashes, 2::BIGINT AS variant_count,
            'PASS' AS status FROM lines l JOIN clean_orders o ON l.order_id = o.order_id""",
    ),
    "content_check_ranges_fact": _with(
        _LINES + "," + _ORDERS,
        """SELECT l.order_id, line_id, 1::BIGINT AS distinct_hashes, 2::BIGINT AS variant_count,
            'PASS' AS status FROM lines l JOIN clean_orders o ON l.order_id = o.order_id""",
    ),
    "content_check_ranges": _RANGES + "SELECT * FROM checked",
    "content_check_ranges_mismatches": _RANGES + "SELECT * FROM checked WHERE status = 'FAIL'",
    "surrogate_keys_stable": _with(
        _VERSIONS,
        """SELECT row_number() OVER (ORDER BY effective > DATE '1995-01-01', customer_id, effective) AS customer_sk,
            CASE WHEN effective = DATE '1995-01-01'
                 THEN row_number() OVER (PARTITION BY effective ORDER BY customer_id) END AS first_sk,
            customer_id, effective AS start
        FROM versions""",
    ),
    "ingest_batches": _BATCH_ORDERS,
    "ingest_stream": _BATCH_ORDERS,
    "load_files_once": _BATCH_ORDERS,
    "star_layer_tests": _with(
        _FACT,
        """SELECT 'fact_order_line' AS table_name, 'not_null' AS test, 'customer_sk' AS column_name,
            count(*) - count(customer_sk) AS failures,
            CASE WHEN count(*) > count(customer_sk) THEN 'FAIL' ELSE 'PASS' END AS status
        FROM fact UNION ALL """
        + " UNION ALL ".join(f"SELECT '{t}', '{k}', '{c}', 0, 'PASS'" for t, k, c in _PASSING),
    ),
}
