"""The registered queries as plain SQL for DuckDB, written independently of the operators.

Only the fixed values (labels, thresholds, domains) are taken from the contracts.
"""

from __future__ import annotations

from tidemark import spec


def _case(conditions: dict[str, str], otherwise: str) -> str:
    """A CASE over SQL conditions; the first that holds names the label."""
    whens = " ".join(f"WHEN {condition} THEN '{label}'" for label, condition in conditions.items())
    return f"CASE {whens} ELSE '{otherwise}' END"


def _domain(values: list[str]) -> str:
    return "(" + ", ".join(f"'{value}'" for value in values) + ")"


_STATUSES, _TIERS = _domain(spec.ORDER_STATUSES), _domain(spec.CUSTOMER_TIERS)
_SEGMENT = _case(spec.RFM_SEGMENTS, spec.RFM_SEGMENT_OTHERWISE)
_CHURN = _case({band: f"recency_days > {days}" for band, days in spec.CHURN_BANDS.items()}, spec.CHURN_OTHERWISE)
_CATEGORY = _case({c: f"pid <= {last}" for last, c, _ in spec.PRODUCT_RANGES[:-1]}, spec.PRODUCT_RANGES[-1][1])
_LABEL = _case({n: f"pid <= {last}" for last, _, n in spec.PRODUCT_RANGES[:-1]}, spec.PRODUCT_RANGES[-1][2])

# Shared building blocks; each query uses the ones it needs.
BLOCKS = {
    "src_customers": """
        SELECT c_custkey AS customer_id,
          CASE WHEN c_custkey % 53 = 0 THEN NULL
               ELSE concat('  ', upper(c_name), '@Example.com ') END AS email,
          concat(' ', c_name, ' ') AS name, r_name AS region,
          CASE c_mktsegment WHEN 'BUILDING' THEN 'standard' WHEN 'AUTOMOBILE' THEN 'standard'
               WHEN 'MACHINERY' THEN 'premium' WHEN 'HOUSEHOLD' THEN 'enterprise'
               ELSE 'trial' END AS tier,
          CAST(DATE '1995-01-01' + CAST(c_custkey % 120 AS INT) AS TIMESTAMP) AS created_at,
          CAST(DATE '1995-01-01' + CAST(c_custkey % 120 + c_custkey % 60 AS INT) AS TIMESTAMP) AS updated_at
        FROM customer JOIN nation ON c_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey""",
    "src_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
          CASE WHEN o_orderkey % 97 = 0 THEN 'bad_status'
               WHEN o_orderpriority LIKE '1%' THEN 'pending'
               WHEN o_orderpriority LIKE '2%' THEN 'confirmed'
               WHEN o_orderpriority LIKE '3%' THEN 'shipped'
               WHEN o_orderpriority LIKE '4%' THEN 'delivered' ELSE 'cancelled' END AS status,
          CAST(CASE WHEN o_orderkey % 101 = 0 THEN -o_totalprice ELSE o_totalprice END
               AS DECIMAL(12,2)) AS total_amount, r_name AS region,
          o_orderdate AS created_at, o_orderdate AS updated_at
        FROM orders JOIN customer ON o_custkey = c_custkey
                    JOIN nation ON c_nationkey = n_nationkey
                    JOIN region ON n_regionkey = r_regionkey""",
    "src_items": """
        SELECT l_orderkey * 10 + l_linenumber AS item_id, l_orderkey AS order_id,
          l_partkey AS product_id,
          CAST(CASE WHEN l_suppkey % 41 = 0 THEN 0 ELSE l_quantity END AS INT) AS quantity,
          CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
          l_shipdate AS created_at, l_shipdate AS updated_at
        FROM lineitem""",
    "valid_customers": f"""
        SELECT * FROM src_customers WHERE customer_id IS NOT NULL AND email IS NOT NULL AND tier IN {_TIERS}""",
    "valid_orders": f"""
        SELECT * FROM src_orders WHERE order_id IS NOT NULL AND total_amount > 0 AND status IN {_STATUSES}""",
    "valid_items": """
        SELECT * FROM src_items WHERE item_id IS NOT NULL AND quantity > 0 AND unit_price > 0""",
    "s_customers": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC NULLS LAST,
            email DESC NULLS LAST, name DESC NULLS LAST, region DESC NULLS LAST, tier DESC NULLS LAST,
            created_at DESC NULLS LAST) AS rn
          FROM valid_customers) WHERE rn = 1""",
    "s_orders": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC NULLS LAST,
            customer_id DESC NULLS LAST, status DESC NULLS LAST, total_amount DESC NULLS LAST,
            region DESC NULLS LAST, created_at DESC NULLS LAST) AS rn
          FROM valid_orders) WHERE rn = 1""",
    "s_items": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY updated_at DESC NULLS LAST,
            order_id DESC NULLS LAST, product_id DESC NULLS LAST, quantity DESC NULLS LAST,
            unit_price DESC NULLS LAST, created_at DESC NULLS LAST) AS rn
          FROM valid_items) WHERE rn = 1""",
    "latest_items": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY updated_at DESC NULLS LAST,
            order_id DESC NULLS LAST, product_id DESC NULLS LAST, quantity DESC NULLS LAST,
            unit_price DESC NULLS LAST, created_at DESC NULLS LAST) AS rn
          FROM src_items) WHERE rn = 1""",
    "d_customer": """
        SELECT customer_id AS customer_key, customer_id, trim(name) AS name,
          lower(trim(email)) AS email, region, tier, TRUE AS is_current,
          created_at AS effective_from, TIMESTAMP '2001-08-02 06:00:00' AS dw_inserted_at
        FROM s_customers""",
    "d_product": f"""
        SELECT pid AS product_key, pid AS product_id,
          {_CATEGORY} AS category, concat({_LABEL}, ' ', pid) AS product_name,
          TRUE AS is_active, TIMESTAMP '2001-08-02 06:00:00' AS dw_inserted_at
        FROM (SELECT unnest(range(CAST(1 AS BIGINT), CAST(201 AS BIGINT))) AS pid)""",
    "n_items": "SELECT order_id, count(*) AS item_count FROM s_items GROUP BY order_id",
    "f_orders": """
        SELECT o.order_id AS order_key, o.order_id, coalesce(c.customer_key, -1) AS customer_key,
          CAST(strftime(o.created_at, '%Y%m%d') AS INTEGER) AS date_key, o.status, o.total_amount,
          coalesce(n.item_count, 0) AS item_count, o.region, o.created_at, o.updated_at,
          TIMESTAMP '2001-08-02 06:00:00' AS dw_inserted_at
        FROM s_orders o LEFT JOIN d_customer c ON o.customer_id = c.customer_id
                        LEFT JOIN n_items n ON o.order_id = n.order_id""",
    "f_items": """
        SELECT i.item_id AS item_key, i.item_id, i.order_id,
          coalesce(c.customer_key, -1) AS customer_key, coalesce(p.product_key, -1) AS product_key,
          CAST(strftime(i.created_at, '%Y%m%d') AS INTEGER) AS date_key, i.quantity,
          CAST(i.unit_price AS DOUBLE) AS unit_price,
          CAST(round(i.quantity * i.unit_price, 2) AS DOUBLE) AS line_total, i.created_at,
          TIMESTAMP '2001-08-02 06:00:00' AS dw_inserted_at
        FROM s_items i LEFT JOIN s_orders o ON i.order_id = o.order_id
                       LEFT JOIN d_customer c ON o.customer_id = c.customer_id
                       LEFT JOIN d_product p ON i.product_id = p.product_id""",
    "calendar_days": """
        SELECT CAST(unnest(generate_series(date_trunc('year', lo), date_trunc('year', hi)
               + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d
        FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders)""",
    "d_date": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
          CAST(day(d) AS INTEGER) AS day_of_month, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
          dayname(d) AS day_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
          CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name,
          CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
          dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) NOT IN (0, 6) AS is_weekday
        FROM calendar_days""",
    "all_history": """
        SELECT customer_key, min(created_at) AS first_order_date, max(created_at) AS last_order_date,
          CAST(date_diff('day', CAST(max(created_at) AS DATE), DATE '2001-08-02') AS INTEGER) AS recency_days,
          count(order_key) AS total_orders, sum(total_amount) AS spent,
          CAST(sum(CAST(total_amount * 100 AS BIGINT)) AS BIGINT) AS cents,
          CAST(sum(item_count) AS BIGINT) AS total_items
        FROM f_orders GROUP BY customer_key""",
    "profile_all": """
        SELECT h.customer_key, c.customer_id, c.name, c.email, c.region, c.tier,
          first_order_date, last_order_date, recency_days, total_orders, spent,
          (2 * cents + total_orders) // (2 * total_orders) / 100.0 AS avg_order_value, total_items
        FROM all_history h LEFT JOIN d_customer c ON h.customer_key = c.customer_key""",
    "profile": """
        SELECT * FROM profile_all WHERE customer_key IN (SELECT customer_key FROM d_customer)""",
    "tiles": """
        SELECT *,
          CAST(6 - ntile(5) OVER (ORDER BY recency_days, customer_key) AS INTEGER) AS r_score,
          CAST(ntile(5) OVER (ORDER BY total_orders, customer_key) AS INTEGER) AS f_score,
          CAST(ntile(5) OVER (ORDER BY spent, customer_key) AS INTEGER) AS m_score
        FROM profile""",
    "ranked": """
        SELECT *, count(*) OVER () AS n,
          rank() OVER (ORDER BY recency_days DESC) + (count(*) OVER (PARTITION BY recency_days) - 1) / 2.0 AS r_rank,
          rank() OVER (ORDER BY total_orders) + (count(*) OVER (PARTITION BY total_orders) - 1) / 2.0 AS f_rank,
          rank() OVER (ORDER BY spent) + (count(*) OVER (PARTITION BY spent) - 1) / 2.0 AS m_rank
        FROM profile_all""",
    "percentiles": """
        SELECT * EXCLUDE (n, r_rank, f_rank, m_rank),
          CAST(round_even(least(greatest(CAST(r_rank AS DOUBLE) / n * 4 + 1, 1), 5), 0) AS INTEGER) AS r_score,
          CAST(round_even(least(greatest(CAST(f_rank AS DOUBLE) / n * 4 + 1, 1), 5), 0) AS INTEGER) AS f_score,
          CAST(round_even(least(greatest(CAST(m_rank AS DOUBLE) / n * 4 + 1, 1), 5), 0) AS INTEGER) AS m_score
        FROM ranked""",
}

_LABELS = """
    SELECT customer_key, customer_id, name, email, region, tier, first_order_date, last_order_date,
      recency_days, total_orders, CAST(spent AS DOUBLE) AS total_spent, avg_order_value, total_items,
      r_score, f_score, m_score, concat(r_score, f_score, m_score) AS rfm_score,
      {segment} AS rfm_segment, {churn} AS churn_risk,
      TIMESTAMP '2001-08-02 06:00:00' AS pipeline_updated_at
    FROM {scores}"""
BLOCKS["mart"] = _LABELS.format(scores="tiles", segment=_SEGMENT, churn=_CHURN)
BLOCKS["mart_pct"] = _LABELS.format(scores="percentiles", segment=_SEGMENT, churn=_CHURN)

BLOCKS["first_batch"] = """
    SELECT * FROM events WHERE ts > TIMESTAMP '2023-12-31 23:45:00' AND ts <= TIMESTAMP '2024-01-15 12:00:00'"""
BLOCKS["second_batch"] = """
    SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 11:45:00' AND ts <= TIMESTAMP '2024-01-31 00:00:00'"""
BLOCKS["control"] = """
    SELECT event_type AS pipeline_name, max(ts) AS last_watermark,
      TIMESTAMP '2024-01-15 12:00:00' AS last_run_at, 'new' AS status
    FROM first_batch GROUP BY event_type"""
BLOCKS["moved"] = """
    SELECT DISTINCT event_type AS pipeline_name, TIMESTAMP '2024-01-31 00:00:00' AS last_watermark,
      TIMESTAMP '2024-01-31 00:00:00' AS last_run_at, 'success' AS status
    FROM second_batch WHERE value > 0 AND event_type <> 'error'"""
BLOCKS["late_orders"] = """
    SELECT * REPLACE ('delivered' AS status, updated_at + INTERVAL 1 DAY AS updated_at) FROM src_orders
    WHERE updated_at > TIMESTAMP '2000-01-01' AND updated_at <= TIMESTAMP '2001-01-01'"""

BLOCKS["changed_orders"] = """
    SELECT order_id, CASE WHEN order_id % 3 = 0 THEN customer_id + 1 ELSE customer_id END AS customer_id,
      'delivered' AS status, CAST(total_amount * 2 AS DECIMAL(12,2)) AS total_amount, region, created_at
    FROM late_orders"""
BLOCKS["valid_changed"] = "SELECT * FROM changed_orders WHERE order_id IS NOT NULL AND total_amount > 0"
BLOCKS["f_orders_changed"] = """
    SELECT o.order_id AS order_key, coalesce(c.customer_key, -1) AS customer_key, o.total_amount, o.created_at,
      coalesce(n.item_count, 0) AS item_count
    FROM (SELECT * FROM valid_changed
          UNION ALL SELECT order_id, customer_id, status, total_amount, region, created_at FROM s_orders
          WHERE order_id NOT IN (SELECT order_id FROM valid_changed)) o
    LEFT JOIN d_customer c ON o.customer_id = c.customer_id LEFT JOIN n_items n ON o.order_id = n.order_id"""
BLOCKS["totals_changed"] = """
    SELECT customer_key, min(created_at) AS first_order_date, max(created_at) AS last_order_date,
      count(order_key) AS total_orders, CAST(sum(CAST(total_amount * 100 AS BIGINT)) AS BIGINT) AS cents,
      CAST(sum(item_count) AS BIGINT) AS total_items
    FROM f_orders_changed GROUP BY customer_key"""

_ORDER_COLUMNS = """order_id, customer_id, status, CAST(total_amount AS DOUBLE) AS total_amount,
    region, created_at, updated_at"""
_ITEM_COLUMNS = """item_id, order_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
    created_at, updated_at"""


def _distribution(label: str) -> str:
    return f"""
        SELECT {label}, customers,
          (2000 * customers + total) // (2 * total) / 10.0 AS pct,
          repeat('#', CAST(customers * 30 // total AS INTEGER)) AS bar
        FROM (SELECT {label}, count(*) AS customers, CAST(sum(count(*)) OVER () AS BIGINT) AS total
              FROM mart GROUP BY {label})
        ORDER BY customers DESC, {label}"""


def _counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}" for name, source in tables.items()
    )


_CHANGED = " WHERE updated_at > TIMESTAMP '2000-01-01' AND updated_at <= TIMESTAMP '2001-01-01'"

QUERIES = {
    "extract_window": "SELECT * FROM first_batch",
    "extract_overlap": "SELECT * FROM second_batch",
    "extract_counts": "WITH c AS ("
    + _counts(
        {
            "orders": "src_orders" + _CHANGED,
            "customers": "src_customers" + _CHANGED,
            "order_items": "src_items" + _CHANGED,
        }
    )
    + ") SELECT * FROM c UNION ALL SELECT 'total', CAST(sum(row_count) AS BIGINT) FROM c",
    "extract_max_key": "SELECT max(order_id) AS order_id FROM src_orders",
    "watermark_read": """
        SELECT pipeline_name, last_watermark, last_watermark - INTERVAL 15 MINUTE AS window_start FROM control""",
    "watermark_advance": """
        SELECT * FROM moved
        UNION ALL SELECT * FROM control WHERE pipeline_name NOT IN (SELECT pipeline_name FROM moved)""",
    "incremental_reduction": """
        SELECT source_rows, window_rows,
          (2000 * (source_rows - window_rows) + source_rows) // (2 * source_rows) / 10.0 AS reduction_pct,
          window_rows < source_rows AS incremental
        FROM (SELECT (SELECT count(*) FROM events) AS source_rows,
                     (SELECT count(*) FROM second_batch) AS window_rows)""",
    "bronze_roundtrip": """
        SELECT *, '2024' AS year, '01' AS month, '15' AS day, '20240115_120000' AS batch FROM first_batch
        UNION ALL
        SELECT *, '2024' AS year, '01' AS month, '31' AS day, '20240131_000000' AS batch FROM second_batch""",
    "bronze_union_batches": """
        SELECT * REPLACE (CAST(NULL AS VARCHAR) AS props) FROM first_batch
        UNION ALL SELECT * REPLACE (CAST(NULL AS BIGINT) AS user_id) FROM second_batch""",
    "validate_orders": f"SELECT {_ORDER_COLUMNS} FROM valid_orders",
    "validate_customers": "SELECT * FROM valid_customers",
    "validate_items": f"SELECT {_ITEM_COLUMNS} FROM valid_items",
    "rule_drop_counts": """
        SELECT 'orders' AS table_name, 1 AS rule_order, 'key_present' AS rule,
          count(*) FILTER (order_id IS NULL) AS dropped FROM src_orders
        UNION ALL SELECT 'orders', 2, 'amount_positive',
          count(*) FILTER (order_id IS NOT NULL AND NOT coalesce(total_amount > 0, FALSE)) FROM src_orders
        UNION ALL SELECT 'orders', 3, 'status_known',
          count(*) FILTER (order_id IS NOT NULL AND total_amount > 0 AND NOT coalesce(status IN
            """ + _STATUSES + """, FALSE)) FROM src_orders
        UNION ALL SELECT 'customers', 1, 'key_present', count(*) FILTER (customer_id IS NULL) FROM src_customers
        UNION ALL SELECT 'customers', 2, 'email_present',
          count(*) FILTER (customer_id IS NOT NULL AND email IS NULL) FROM src_customers
        UNION ALL SELECT 'customers', 3, 'tier_known',
          count(*) FILTER (customer_id IS NOT NULL AND email IS NOT NULL AND NOT coalesce(tier IN
            """ + _TIERS + """, FALSE)) FROM src_customers
        UNION ALL SELECT 'order_items', 1, 'key_present', count(*) FILTER (item_id IS NULL) FROM src_items
        UNION ALL SELECT 'order_items', 2, 'quantity_positive',
          count(*) FILTER (item_id IS NOT NULL AND NOT coalesce(quantity > 0, FALSE)) FROM src_items
        UNION ALL SELECT 'order_items', 3, 'price_positive',
          count(*) FILTER (item_id IS NOT NULL AND quantity > 0 AND NOT coalesce(unit_price > 0, FALSE))
          FROM src_items""",
    "rejected_orders": f"""
        SELECT {_ORDER_COLUMNS}, CASE WHEN order_id IS NULL THEN 'key_present'
          WHEN total_amount > 0 THEN 'status_known' ELSE 'amount_positive' END AS broken_rule
        FROM src_orders EXCEPT ALL
        SELECT {_ORDER_COLUMNS}, 'status_known' AS broken_rule FROM valid_orders""",
    "leak_check": """
        WITH bad_orders AS (SELECT * FROM src_orders EXCEPT SELECT * FROM valid_orders),
             bad_customers AS (SELECT * FROM src_customers EXCEPT SELECT * FROM valid_customers),
             bad_items AS (SELECT * FROM src_items EXCEPT SELECT * FROM valid_items)
        SELECT 'orders' AS table_name, count(DISTINCT order_id) AS bad_keys,
          (SELECT count(*) FROM (SELECT * FROM s_orders INTERSECT SELECT * FROM bad_orders)) AS leaked
        FROM bad_orders
        UNION ALL
        SELECT 'customers', count(DISTINCT customer_id),
          (SELECT count(*) FROM (SELECT * FROM s_customers INTERSECT SELECT * FROM bad_customers)) FROM bad_customers
        UNION ALL
        SELECT 'order_items', count(DISTINCT item_id),
          (SELECT count(*) FROM (SELECT * FROM s_items INTERSECT SELECT * FROM bad_items)) FROM bad_items""",
    "quality_gate": """
        SELECT count(*) AS rows_before, count(*) + 1 AS rows_after, CAST(0 AS BIGINT) AS bad_leaked,
          CAST(1 AS BIGINT) AS good_passed, TRUE AS passed FROM s_orders""",
    "dedup_latest": f"SELECT {_ITEM_COLUMNS} FROM latest_items",
    "dedup_counts": """
        SELECT 'orders' AS table_name, count(*) AS rows_in, count(DISTINCT order_id) AS rows_kept,
          count(*) - count(DISTINCT order_id) AS rows_removed FROM src_orders
        UNION ALL SELECT 'customers', count(*), count(DISTINCT customer_id),
          count(*) - count(DISTINCT customer_id) FROM src_customers
        UNION ALL SELECT 'order_items', count(*), count(DISTINCT item_id),
          count(*) - count(DISTINCT item_id) FROM src_items""",
    "silver_orders": f"SELECT {_ORDER_COLUMNS} FROM s_orders",
    "silver_customers": "SELECT * FROM s_customers",
    "silver_order_items": f"SELECT {_ITEM_COLUMNS} FROM s_items",
    "silver_items_dedup_first": f"""
        SELECT {_ITEM_COLUMNS} FROM latest_items WHERE item_id IS NOT NULL AND quantity > 0 AND unit_price > 0""",
    "stream_pickup": f"""
        SELECT {_ORDER_COLUMNS} FROM (
          SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC) AS rn
          FROM (SELECT * FROM src_orders UNION ALL SELECT * FROM late_orders)
          WHERE total_amount > 0 AND status IN {_STATUSES})
        WHERE rn = 1""",
    "upsert_orders": f"""
        WITH target AS (SELECT * FROM valid_orders WHERE updated_at < TIMESTAMP '2000-01-01'),
             source AS (SELECT * REPLACE ('delivered' AS status) FROM valid_orders
                        WHERE updated_at >= TIMESTAMP '1999-07-01')
        SELECT {_ORDER_COLUMNS} FROM source
        UNION ALL SELECT {_ORDER_COLUMNS} FROM target t
        WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.order_id = t.order_id)""",
    "scd1_customer": """
        WITH target AS (SELECT * REPLACE (TIMESTAMP '2024-01-15 12:00:00' AS dw_inserted_at) FROM d_customer
               WHERE customer_id IN (SELECT customer_id FROM s_customers WHERE updated_at < TIMESTAMP '1995-04-01')),
             source AS (SELECT * REPLACE (TIMESTAMP '2024-01-31 00:00:00' AS dw_inserted_at,
               'enterprise' AS tier, concat('new.', email) AS email) FROM d_customer
               WHERE customer_id IN (SELECT customer_id FROM s_customers WHERE updated_at >= TIMESTAMP '1995-03-01'))
        SELECT * FROM source
        UNION ALL SELECT * FROM target t
        WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.customer_key = t.customer_key)""",
    "snapshot_counts": """
        SELECT 'orders' AS table_name, count(*) AS row_count, 2 AS version FROM s_orders
        UNION ALL SELECT 'customers', count(*), 0 FROM s_customers
        UNION ALL SELECT 'order_items', 0, -1""",
    "dim_customer": "SELECT * FROM d_customer",
    "dim_product": """
        SELECT p.*, count(i.item_id) AS lines, CAST(coalesce(sum(i.quantity), 0) AS BIGINT) AS units
        FROM d_product p LEFT JOIN s_items i ON p.product_id = i.product_id GROUP BY ALL""",
    "dim_date": "SELECT * FROM d_date",
    "dim_date_iso": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
          CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS day_of_week,
          dayname(d) AS day_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
          CAST(month(d) AS INTEGER) AS month_number, monthname(d) AS month_name,
          CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
          isodow(d) >= 6 AS is_weekend, isodow(d) < 6 AS is_weekday
        FROM (SELECT CAST(unnest(generate_series(date_trunc('year', lo), date_trunc('year', hi)
              + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem))""",
    "item_counts": "SELECT * FROM n_items",
    "fact_orders": "SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM f_orders",
    "fact_order_items": "SELECT * FROM f_items",
    "unresolved_keys": """
        SELECT 'fact_orders' AS fact, 'customer_key' AS key_name,
          count(*) FILTER (customer_key = -1) AS unresolved FROM f_orders
        UNION ALL SELECT 'fact_order_items', 'customer_key', count(*) FILTER (customer_key = -1) FROM f_items
        UNION ALL SELECT 'fact_order_items', 'product_key', count(*) FILTER (product_key = -1) FROM f_items""",
    "fact_by_calendar": """
        SELECT year, quarter, month_number, month_name, count(*) AS orders,
          CAST(sum(item_count) AS BIGINT) AS items, count(*) FILTER (is_weekend) AS weekend_orders,
          CAST(sum(total_amount) AS DOUBLE) AS revenue
        FROM f_orders JOIN d_date USING (date_key) GROUP BY ALL""",
    "customer_profile": "SELECT * EXCLUDE (spent), CAST(spent AS DOUBLE) AS total_spent FROM profile",
    "rfm_ntile_scores": """
        SELECT customer_key, recency_days, total_orders, CAST(spent AS DOUBLE) AS total_spent,
          r_score, f_score, m_score FROM tiles""",
    "rfm_null_scores": """
        WITH gaps AS (SELECT * REPLACE (CASE WHEN customer_key % 3 <> 0 THEN recency_days END AS recency_days) FROM profile)
        SELECT customer_key, recency_days, total_orders, CAST(spent AS DOUBLE) AS total_spent,
          CAST(6 - ntile(5) OVER (ORDER BY recency_days NULLS FIRST, customer_key) AS INTEGER) AS r_score,
          CAST(ntile(5) OVER (ORDER BY total_orders, customer_key) AS INTEGER) AS f_score,
          CAST(ntile(5) OVER (ORDER BY spent, customer_key) AS INTEGER) AS m_score
        FROM gaps""",
    "rfm_pct_scores": """
        SELECT customer_key, recency_days, total_orders, CAST(spent AS DOUBLE) AS total_spent,
          r_score, f_score, m_score FROM percentiles""",
    "rfm_mart": "SELECT * FROM mart",
    "rfm_mart_pct": "SELECT * FROM mart_pct",
    "mart_validation": """
        SELECT 'Total customers' AS metric, CAST(count(*) AS DOUBLE) AS value FROM mart
        UNION ALL SELECT 'Avg recency days',
          CAST((20 * sum(recency_days) + count(*)) // (2 * count(*)) AS DOUBLE) / 10.0 FROM mart
        UNION ALL SELECT 'HIGH churn risk count', CAST(count(*) AS DOUBLE) FROM mart WHERE churn_risk = 'HIGH'
        UNION ALL SELECT 'Champions count', CAST(count(*) AS DOUBLE) FROM mart WHERE rfm_segment = 'Champions'""",
    "segment_distribution": _distribution("rfm_segment"),
    "churn_distribution": _distribution("churn_risk"),
    "layer_row_counts": _counts(
        {
            "bronze_orders": "src_orders",
            "bronze_customers": "src_customers",
            "bronze_order_items": "src_items",
            "silver_orders": "s_orders",
            "silver_customers": "s_customers",
            "silver_order_items": "s_items",
            "gold_dim_customer": "d_customer",
            "gold_fact_orders": "f_orders",
            "gold_fact_order_items": "f_items",
        }
    ),
    "idempotency_check": """
        SELECT table_name, n AS first_rows, n AS second_rows, CAST(0 AS BIGINT) AS rows_differing, TRUE AS identical
        FROM (SELECT 'dim_customer' AS table_name, count(*) AS n FROM d_customer
              UNION ALL SELECT 'orders', count(*) FROM s_orders
              UNION ALL SELECT 'customers', count(*) FROM s_customers
              UNION ALL SELECT 'order_items', count(*) FROM s_items
              UNION ALL SELECT 'dim_product', 200
              UNION ALL SELECT 'dim_date', CAST(DATE '2027-12-31' - DATE '2024-01-01' AS BIGINT) + 1
              UNION ALL SELECT 'fact_order_items', count(*) FROM f_items
              UNION ALL SELECT 'fact_orders', count(*) FROM f_orders
              UNION ALL SELECT 'customer_mart', count(*) FROM mart)""",
}
QUERIES["end_to_end_run"] = QUERIES["rfm_mart"]
QUERIES["totals_change"] = "SELECT * FROM totals_changed"
QUERIES["profile_delta"] = """
    SELECT t.customer_key, c.customer_id, c.name, c.email, c.region, c.tier, first_order_date, last_order_date,
      CAST(date_diff('day', CAST(last_order_date AS DATE), DATE '2001-08-02') AS INTEGER) AS recency_days, total_orders,
      CAST(cents AS DOUBLE) / 100 AS total_spent,
      (2 * cents + total_orders) // (2 * total_orders) / 100.0 AS avg_order_value, total_items
    FROM totals_changed t JOIN d_customer c ON t.customer_key = c.customer_key"""
QUERIES["late_customers"] = """
    WITH orders_at AS (
           SELECT o.order_id, c.customer_id IS NULL AS after_, c.customer_id IS NULL OR c.customer_id % 3 = 0 AS before_
           FROM s_orders o LEFT JOIN d_customer c ON o.customer_id = c.customer_id),
         items_at AS (
           SELECT i.item_id, coalesce(o.after_, TRUE) AS after_, coalesce(o.before_, TRUE) AS before_
           FROM s_items i LEFT JOIN orders_at o ON i.order_id = o.order_id),
         counted AS (
           SELECT 'fact_orders' AS fact, count(*) FILTER (before_) AS before, count(*) FILTER (after_) AS after FROM orders_at
           UNION ALL SELECT 'fact_order_items', count(*) FILTER (before_), count(*) FILTER (after_) FROM items_at)
    SELECT *, after < before AS fell FROM counted"""
QUERIES["quarantine_rows"] = QUERIES["rejected_orders"]
QUERIES["quarantine_counts"] = QUERIES["rule_drop_counts"]
QUERIES["stored_row_counts"] = QUERIES["layer_row_counts"]
QUERIES["catalog_tables"] = QUERIES["silver_orders"]
QUERIES["stream_overlap"] = "SELECT * FROM first_batch UNION SELECT * FROM second_batch"
QUERIES["mart_reports"] = f"""
    SELECT 'rfm_segment' AS report, rfm_segment AS label, CAST(count(*) AS DOUBLE) AS value FROM mart GROUP BY rfm_segment
    UNION ALL SELECT 'churn_risk', churn_risk, CAST(count(*) AS DOUBLE) FROM mart GROUP BY churn_risk
    UNION ALL SELECT 'metric', metric, value FROM ({QUERIES["mart_validation"]})"""
QUERIES["idempotency_ranges"] = """
    WITH keys AS (
      SELECT 'orders' AS table_name, order_id AS k FROM s_orders
      UNION ALL SELECT 'customers', customer_id FROM s_customers
      UNION ALL SELECT 'order_items', item_id FROM s_items
      UNION ALL SELECT 'dim_customer', customer_key FROM d_customer
      UNION ALL SELECT 'dim_product', product_key FROM d_product
      UNION ALL SELECT 'dim_date', CAST(strftime(CAST(d AS DATE), '%Y%m%d') AS BIGINT)
        FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2027-12-31', INTERVAL 1 DAY)) AS d)
      UNION ALL SELECT 'fact_orders', order_key FROM f_orders
      UNION ALL SELECT 'fact_order_items', item_key FROM f_items
      UNION ALL SELECT 'customer_mart', customer_key FROM mart)
    SELECT table_name, count(*) AS first_rows, count(*) AS second_rows, count(DISTINCT k // 1000) AS ranges,
      CAST(0 AS BIGINT) AS ranges_differing, TRUE AS identical
    FROM keys GROUP BY table_name"""
QUERIES["changed_keys"] = """
    SELECT order_id, CAST(CASE WHEN order_id % 50 = 3 THEN 0 ELSE 1 END AS BIGINT) AS first_rows,
      CAST(CASE order_id % 50 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END AS BIGINT) AS second_rows,
      CASE order_id % 50 WHEN 0 THEN 'lost' WHEN 1 THEN 'repeated' WHEN 2 THEN 'changed' ELSE 'new' END AS difference
    FROM s_orders WHERE order_id % 50 <= 3"""
QUERIES["catalog_registry"] = """
    SELECT 'customers_as' AS table_name, count(*) AS row_count, 7 AS columns, TRUE AS created_once FROM s_customers
    UNION ALL SELECT 'order_items_as', count(*), 7, TRUE FROM s_items
    UNION ALL SELECT 'dim_customer', 0, 9, FALSE"""
QUERIES["file_inventory"] = """
    SELECT '20000101_000000' AS batch, least(8, count(*)) AS files, CAST(count(*) AS BIGINT) AS rows, TRUE AS bytes_match
    FROM src_orders
    UNION ALL SELECT '20010101_000000', least(3, count(*)), count(*), TRUE FROM src_orders"""
QUERIES["extract_empty_window"] = """
    WITH c AS (SELECT * FROM (""" + QUERIES["extract_counts"] + """) WHERE table_name <> 'total')
    SELECT *, row_count > 0 AS landed FROM c"""
QUERIES["upsert_key_ranges"] = QUERIES["upsert_orders"]
QUERIES["batch_concat"] = QUERIES["bronze_union_batches"]


def sql(name: str) -> str:
    blocks = ", ".join(f"{block} AS ({text})" for block, text in BLOCKS.items())
    return f"WITH {blocks} SELECT * FROM ({QUERIES[name]})"
