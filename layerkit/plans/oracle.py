"""Independent SQL twin (DuckDB dialect) of every registered query.

The fixture rules of ``sources/testtables.py`` are spelled again here in plain SQL, then
silver, SCD1, SCD2 and the marts are written from their rules in other terms than the Spark build
plans them (whole-cent sums, counts over de-duplicated subqueries, window ``LAG``/``LEAD``), so a
planning shortcut in Spark cannot hide in both.

Exactness:

* ``ROUND(double, 2)`` rounds half-up on the shortest decimal text of the double (as Spark
  does): ``CAST(ROUND(CAST(CAST(x AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)``;
* money sums are exact decimal sums, and averages are rounded half-up from exact integer
  cents, ``(2*cents + n) // (2*n) / 100`` (valid sums are non-negative).
"""

from __future__ import annotations


def r2(x: str) -> str:
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def dsum(x: str) -> str:
    return f"SUM(CAST({x} AS DECIMAL(18,2)))"


def avg2_money(x: str) -> str:
    n = f"COUNT({x})"
    return f"CAST((2 * CAST({dsum(x)} * 100 AS BIGINT) + {n}) // (2 * {n}) AS DOUBLE) / 100"


def avg2_int(x: str) -> str:
    n = f"COUNT({x})"
    return f"CAST((200 * SUM({x}) + {n}) // (2 * {n}) AS DOUBLE) / 100"


def desc(cols: list[str]) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


EMAIL = "UPPER(REPLACE(c.c_name, '#', '.')) || '@SHOP.TEST'"
LK = "(l.l_orderkey + l.l_linenumber)"

FIXTURE = f"""
cust_base AS (
  SELECT c.c_custkey AS k,
         CAST(c.c_custkey AS VARCHAR) AS customer_id,
         CASE WHEN c.c_custkey % 97 = 13 THEN NULL
              WHEN c.c_custkey % 89 = 17 THEN '   '
              WHEN c.c_custkey % 5 = 0 THEN '  ' || c.c_name || ' '
              ELSE c.c_name END AS name,
         CASE WHEN c.c_custkey % 31 = 3 THEN NULL
              WHEN c.c_custkey % 83 = 19 THEN NULL
              WHEN c.c_custkey % 79 = 23 THEN ''
              WHEN c.c_custkey % 3 = 1 THEN ' ' || {EMAIL} || ' '
              ELSE {EMAIL} END AS email,
         CASE WHEN c.c_custkey % 7 = 2 THEN c.c_mktsegment || ' ' ELSE c.c_mktsegment END AS membership_level,
         r.r_name AS region,
         {EMAIL} AS email_raw
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
raw_customers AS (
  SELECT k, customer_id, name, email, membership_level, region, email_raw,
         TIMESTAMP '2023-12-31 00:00:00' AS _ingested_at, 'customer' AS _source_file
  FROM cust_base
  UNION ALL
  SELECT b.k, b.customer_id, b.name, b.email, e.event_type, b.region, b.email_raw,
         e.ts, 'events'
  FROM events e JOIN cust_base b ON e.user_id = b.k
),
raw_orders AS (
  SELECT o_orderkey AS k,
         CASE WHEN o_orderkey % 211 = 47 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
         CASE WHEN o_orderkey % 103 = 29 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         CASE WHEN o_orderkey % 107 = 31 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS order_date,
         CASE WHEN o_orderkey % 37 = 6 THEN NULL
              WHEN o_orderkey % 89 = 37 THEN -o_totalprice
              WHEN o_orderkey % 113 = 41 THEN CAST(0 AS DOUBLE)
              ELSE o_totalprice END AS total_amount,
         CASE WHEN o_orderkey % 53 = 43 THEN NULL
              WHEN o_orderstatus = 'O' THEN ' delivered'
              WHEN o_orderstatus = 'F' THEN 'Shipped '
              ELSE 'pending' END AS status,
         o_orderdate AS _ingested_at, 'orders' AS _source_file
  FROM orders
),
raw_line_items AS (
  SELECT {LK} AS k,
         CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS line_item_id,
         CAST(l.l_orderkey AS VARCHAR) AS order_id,
         CASE WHEN l.l_partkey % 59 = 7 THEN ' '
              WHEN l.l_partkey % 61 = 11 THEN NULL
              WHEN l.l_partkey % 4 = 1 THEN ' ' || p.p_name || '  '
              ELSE p.p_name END AS product_name,
         CASE WHEN {LK} % 41 = 3 THEN NULL
              WHEN {LK} % 67 = 5 THEN 0
              WHEN {LK} % 71 = 9 THEN -CAST(l.l_quantity AS INTEGER)
              ELSE CAST(l.l_quantity AS INTEGER) END AS quantity,
         CASE WHEN {LK} % 73 = 15 THEN -(l.l_extendedprice / l.l_quantity)
              WHEN {LK} % 79 = 21 THEN CAST(0 AS DOUBLE)
              ELSE l.l_extendedprice / l.l_quantity END AS unit_price,
         l.l_shipdate AS _ingested_at, 'lineitem' AS _source_file
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""

# Cleaned payload of each entity as (name, SQL). Validity is one boolean: every rule holds.
CLEANED = {
    "customers": [
        ("name", "TRIM(name)"),
        ("email", "LOWER(TRIM(email))"),
        ("membership_level", "TRIM(membership_level)"),
        ("region", "TRIM(region)"),
        ("is_valid", "LENGTH(TRIM(COALESCE(email, ''))) > 0 AND LENGTH(TRIM(COALESCE(name, ''))) > 0"),
    ],
    "orders": [
        ("customer_id", "customer_id"),
        ("order_date", "order_date"),
        ("order_year", "CAST(DATE_PART('year', order_date) AS INTEGER)"),
        ("order_month", "CAST(DATE_PART('month', order_date) AS INTEGER)"),
        ("total_amount", r2("total_amount")),
        ("status", "UPPER(TRIM(status))"),
        ("is_valid", "customer_id IS NOT NULL AND order_date IS NOT NULL AND COALESCE(total_amount, -1) >= 0"),
    ],
    "line_items": [
        ("order_id", "order_id"),
        ("product_name", "TRIM(product_name)"),
        ("quantity", "quantity"),
        ("unit_price", r2("unit_price")),
        ("line_total", r2("quantity * unit_price")),
        ("is_valid", "order_id IS NOT NULL AND LENGTH(TRIM(COALESCE(product_name, ''))) > 0"
                     " AND COALESCE(quantity, 0) > 0 AND COALESCE(unit_price, -1) >= 0"),
    ],
}
KEY = {"customers": "customer_id", "orders": "order_id", "line_items": "line_item_id"}


def silver_cte(entity: str) -> str:
    cols = ", ".join(f"{sql} AS {name}" for name, sql in CLEANED[entity])
    key = KEY[entity]
    return f"""
silver_{entity} AS (SELECT {key}, {cols}, _ingested_at, _source_file FROM raw_{entity} WHERE {key} IS NOT NULL)"""


SILVER = ",".join(silver_cte(e) for e in CLEANED)

ORDER_PAYLOAD = ["customer_id", "order_date", "order_year", "order_month", "total_amount", "status", "is_valid"]
LINE_PAYLOAD = ["order_id", "product_name", "quantity", "unit_price", "line_total", "is_valid"]
CUST_PAYLOAD = ["name", "email", "membership_level", "region", "is_valid"]


def scd1_cte(name: str, source: str, key: str, payload: list[str]) -> str:
    cols = ", ".join([key] + payload)
    return f"""
{name} AS (
  SELECT {cols} FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY {key}
             ORDER BY _ingested_at DESC NULLS LAST, _source_file DESC NULLS LAST, {desc(payload)}) AS rn
    FROM {source}) WHERE rn = 1
)"""


def ties_cte(name: str, source: str, key: str, payload: list[str]) -> str:
    cols = ", ".join([key, "_ingested_at", "_source_file"] + payload)
    return f"""
{name} AS (
  SELECT {cols} FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY {key}, _ingested_at
             ORDER BY _source_file DESC NULLS LAST, {desc(payload)}) AS rn
    FROM {source}) WHERE rn = 1
)"""


def scd2_cte(name: str, source: str, key: str, payload: list[str]) -> str:
    lags = ", ".join(f"LAG({c}) OVER w AS prev_{c}" for c in payload)
    changed = " OR ".join(f"prev_{c} IS DISTINCT FROM {c}" for c in payload)
    cols = ", ".join([key] + payload)
    return f"""
{name}_ties AS (
  SELECT * FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY {key}, _ingested_at
             ORDER BY _source_file DESC NULLS LAST, {desc(payload)}) AS rn
    FROM {source}) WHERE rn = 1
),
{name}_cmp AS (
  SELECT *, ROW_NUMBER() OVER w AS pos, {lags}
  FROM {name}_ties WINDOW w AS (PARTITION BY {key} ORDER BY _ingested_at)
),
{name} AS (
  SELECT {cols}, _ingested_at AS __START_AT,
         LEAD(_ingested_at) OVER (PARTITION BY {key} ORDER BY _ingested_at) AS __END_AT
  FROM {name}_cmp WHERE pos = 1 OR {changed}
)"""


GOLD = (
    scd1_cte("fact_orders", "silver_orders", "order_id", ORDER_PAYLOAD)
    + ","
    + scd1_cte("fact_line_items", "silver_line_items", "line_item_id", LINE_PAYLOAD)
    + ","
    + scd2_cte("dim_customers", "silver_customers", "customer_id", CUST_PAYLOAD)
)


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


BASE = with_ctes(FIXTURE, SILVER, GOLD)

def cents(column: str, rows: str = "true") -> str:
    """Exact sum of an amount over marked rows, in whole cents, as DOUBLE dollars."""
    return f"CAST(COALESCE(SUM(CAST(ROUND({column} * 100) AS HUGEINT)) FILTER (WHERE {rows}), 0) AS DOUBLE) / 100"


# orders that count, with the region and tier of the customer's open version
COUNTED_ORDERS = """(
  SELECT d.region, d.membership_level, DATE_TRUNC('month', f.order_date)::TIMESTAMP AS order_month,
         f.customer_id, f.total_amount AS amount,
         COALESCE(f.status = 'DELIVERED', false) AS delivered, COALESCE(f.status = 'SHIPPED', false) AS shipped,
         COALESCE(f.status <> 'DELIVERED' AND f.status <> 'SHIPPED', false) AS other
  FROM dim_customers d, fact_orders f
  WHERE f.is_valid AND d.__END_AT IS NULL AND d.customer_id = f.customer_id
)"""
M1 = f"""
SELECT g.*, u.unique_customers
FROM (
  SELECT region, membership_level, order_month, COUNT(*) AS order_count,
         {cents('amount')} AS total_revenue, {avg2_money('amount')} AS avg_order_value,
         MAX(amount) AS max_order_value, MIN(amount) AS min_order_value,
         {cents('amount', 'delivered')} AS delivered_revenue, {cents('amount', 'shipped')} AS shipped_revenue,
         {cents('amount', 'other')} AS other_revenue,
         COUNT(*) FILTER (WHERE delivered) AS delivered_order_count,
         COUNT(*) FILTER (WHERE shipped) AS shipped_order_count,
         COUNT(*) FILTER (WHERE other) AS other_order_count
  FROM {COUNTED_ORDERS} GROUP BY region, membership_level, order_month
) g, (
  SELECT region, membership_level, order_month, COUNT(*) AS unique_customers
  FROM (SELECT DISTINCT region, membership_level, order_month, customer_id FROM {COUNTED_ORDERS})
  GROUP BY region, membership_level, order_month
) u
WHERE g.region IS NOT DISTINCT FROM u.region AND g.membership_level IS NOT DISTINCT FROM u.membership_level
  AND g.order_month IS NOT DISTINCT FROM u.order_month
"""

# lines that count, with the date and status of their order
COUNTED_LINES = """(
  SELECT product_name, order_id, quantity, line_total, unit_price, order_date,
         COALESCE(status = 'DELIVERED', false) AS delivered, COALESCE(status = 'SHIPPED', false) AS shipped
  FROM (SELECT * FROM fact_line_items WHERE is_valid)
  JOIN (SELECT order_id, order_date, status FROM fact_orders WHERE is_valid) USING (order_id)
)"""
M2 = f"""
SELECT g.*, u.distinct_orders, u.delivered_order_count, u.shipped_order_count
FROM (
  SELECT product_name, COUNT(*) AS total_line_items, CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
         {avg2_int('quantity')} AS avg_qty_per_order, {cents('line_total')} AS total_revenue,
         {avg2_money('line_total')} AS avg_line_total, {avg2_money('unit_price')} AS avg_unit_price,
         MIN(unit_price) AS min_unit_price, MAX(unit_price) AS max_unit_price,
         MIN(order_date) AS first_sold_date, MAX(order_date) AS last_sold_date
  FROM {COUNTED_LINES} GROUP BY product_name
) g, (
  SELECT product_name, COUNT(*) AS distinct_orders, COUNT(*) FILTER (WHERE delivered) AS delivered_order_count,
         COUNT(*) FILTER (WHERE shipped) AS shipped_order_count
  FROM (SELECT DISTINCT product_name, order_id, delivered, shipped FROM {COUNTED_LINES}) GROUP BY product_name
) u
WHERE g.product_name = u.product_name
"""

# a customer's JSON text after its opening brace (the test names need no escapes)
CUSTOMER_JSON = " || ',' || ".join(
    f"""'"{c}":' || COALESCE('"' || {c} || '"', 'null')""" for c in ("customer_id", "name", "email", "membership_level", "region")
) + " || '}'"

# --- expected rescue column of each raw entity ------------------------------------------------
RESCUE_EXPECTED = {
    "customers": """CASE WHEN k % 31 = 3 THEN '{"Email":"' || email_raw || '"}'
                        WHEN k % 31 = 5 THEN '{"loyalty_code":"L' || CAST(k AS VARCHAR) || '"}'
                        WHEN k % 31 = 9 THEN '{' || """ + CUSTOMER_JSON + """ || ' {"note":"resent"}'
                        WHEN k % 31 = 11 THEN '{"region":"UNKNOWN",' || """ + CUSTOMER_JSON + """
                        ELSE NULL END""",
    "orders": """NULLIF('{' || CONCAT_WS(',',
                        CASE WHEN k % 107 = 31 THEN '"order_date":"2024-02-30"' END,
                        CASE WHEN k % 37 = 6 THEN '"total_amount":"n/a"' END,
                        CASE WHEN k % 37 = 9 THEN '"coupon":"C' || CAST(k AS VARCHAR) || '"' END) || '}', '{}')""",
    "line_items": """NULLIF('{' || CONCAT_WS(',',
                        CASE WHEN k % 41 = 3 THEN '"quantity":2.5' END,
                        CASE WHEN k % 43 = 7 THEN '"gift_wrap":"yes"' END) || '}', '{}')""",
}
TYPED_COLS = {
    "customers": ["customer_id", "name", "email", "membership_level", "region"],
    "orders": ["order_id", "customer_id", "order_date", "total_amount", "status"],
    "line_items": ["line_item_id", "order_id", "product_name", "quantity", "unit_price"],
}


def ranked_cte(entity: str) -> str:
    """Raw rows with their arrival rank within the key (rows without a key: 1)."""
    key = KEY[entity]
    order = ", ".join(f"{sql} NULLS FIRST" for _, sql in CLEANED[entity])
    return f"""
ranked_{entity} AS (
  SELECT *, CASE WHEN {key} IS NULL THEN 1 ELSE
           ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY _ingested_at NULLS FIRST, {order}) END AS rank
  FROM raw_{entity}
)"""


def ingest_sql(entity: str, lineage: bool = True) -> str:
    cols = ", ".join(TYPED_COLS[entity])
    found = "LEAST(rank, 2)::INTEGER AS delivery, rank = 1 AS first_file, true AS has_file_time" if lineage else "true AS in_several_batches"
    return (
        f"{with_ctes(FIXTURE, ranked_cte(entity))} SELECT {cols}, {RESCUE_EXPECTED[entity]} AS _rescued_data, "
        f"{found} FROM ranked_{entity}"
    )


def clustered_sql() -> str:
    """Rows and key range of the nine clustered datasets; that files are apart is stated."""
    tables = {
        **{f"bronze_{e}": (f"raw_{e}", KEY[e]) for e in KEY}, **{f"silver_{e}": (f"silver_{e}", KEY[e]) for e in KEY},
        "fact_orders": ("fact_orders", "order_id"), "fact_line_items": ("fact_line_items", "line_item_id"),
        "dim_customers": ("(SELECT DISTINCT customer_id FROM silver_customers)", "customer_id"),
    }
    return BASE + " " + " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, COUNT(*) AS row_count, MIN({key}) AS low, MAX({key}) AS high, true AS four_files, true AS disjoint FROM {source}"
        for name, (source, key) in tables.items()
    )


def rescued_union_sql() -> str:
    parts = []
    for entity, key in (("customers", "customer_id"), ("orders", "order_id"), ("line_items", "line_item_id")):
        parts.append(
            f"SELECT '{entity}' AS entity, {key} AS record_key, {RESCUE_EXPECTED[entity]} AS _rescued_data FROM raw_{entity}"
        )
    return with_ctes(FIXTURE) + " " + " UNION ALL ".join(parts)


SILVER_ORDER_COLS = "order_id, customer_id, order_date, order_year, order_month, total_amount, status, is_valid"
LINE_COLS = "line_item_id, order_id, product_name, quantity, unit_price, line_total, is_valid"


# fixed values: what the catalog must say of each dataset
EXPECTED_CATALOG = (
    ("bronze_customers", "bronze", "streaming_table",
     "Customer records as delivered in JSON; fields outside the pinned schema are kept in _rescued_data.", "customer_id"),
    ("bronze_orders", "bronze", "streaming_table",
     "Order records as delivered in JSON, with rescue of unexpected fields.", "order_id"),
    ("bronze_line_items", "bronze", "streaming_table",
     "Order line records as delivered in JSON, with rescue of unexpected fields.", "line_item_id"),
    ("silver_customers", "silver", "streaming_table",
     "Trimmed customers with a lower-case email and a validity flag; every delivery kept.", "customer_id"),
    ("silver_orders", "silver", "streaming_table",
     "Orders with upper-case status, rounded amount, year and month, and a validity flag; every delivery kept.", "order_id"),
    ("silver_line_items", "silver", "streaming_table",
     "Order lines with rounded price, line total and a validity flag; every delivery kept.", "line_item_id"),
    ("dim_customers", "gold", "scd2",
     "Customer dimension with full history (SCD type 2); current rows have __END_AT NULL.", "customer_id"),
    ("fact_orders", "gold", "scd1", "Orders, latest delivery per order_id (SCD type 1).", "order_id"),
    ("fact_line_items", "gold", "scd1", "Order lines, latest delivery per line_item_id (SCD type 1).", "line_item_id"),
    ("gold_sales_by_region_monthly", "gold", "materialized_view",
     "Monthly order and revenue metrics by customer region and tier, current customer versions.", ""),
    ("gold_product_sales_metrics", "gold", "materialized_view",
     "Per-product volume, revenue, price and date-range metrics over valid lines of valid orders.", ""),
)


def skewed_sql() -> str:
    skewed = """
skewed AS (
  SELECT * REPLACE (CASE WHEN _source_file = 'events' AND FLOOR(EPOCH(_ingested_at))::BIGINT % 10 <> 0
                         THEN '1' ELSE customer_id END AS customer_id)
  FROM silver_customers
)"""
    return with_ctes(FIXTURE, SILVER, skewed, scd2_cte("hist", "skewed", "customer_id", CUST_PAYLOAD)) + " SELECT * FROM hist"


def tie_break_sql() -> str:
    """Line items in two files of one batch, the ninth and the tenth: the tenth is later."""
    cols = ", ".join(["line_item_id", "_ingested_at", *LINE_PAYLOAD])
    return with_ctes(FIXTURE, SILVER) + f""", numbered AS (
      SELECT *, CASE WHEN COALESCE(quantity, 0) % 2 = 0 THEN 9 ELSE 10 END AS file_number FROM silver_line_items)
    SELECT {cols}, 'line_items_' || file_number || '.json' AS _source_file FROM numbered
    QUALIFY ROW_NUMBER() OVER (PARTITION BY line_item_id, _ingested_at ORDER BY file_number DESC, {desc(LINE_PAYLOAD)}) = 1"""


def late_sql() -> str:
    cols = ", ".join(["customer_id", *CUST_PAYLOAD])
    latest = scd1_cte("latest", "silver_customers", "customer_id", CUST_PAYLOAD)
    return f"""{with_ctes(FIXTURE, SILVER, latest, scd2_cte("hist", "silver_customers", "customer_id", CUST_PAYLOAD))}
      SELECT {cols}, 'scd1' AS kind, NULL::TIMESTAMP AS __START_AT, NULL::TIMESTAMP AS __END_AT FROM latest
      UNION ALL SELECT {cols}, 'scd2', __START_AT, __END_AT FROM hist"""


def incremental_history_sql() -> str:
    """Versions over four deliveries; of several rows of a key in one delivery the last counts."""
    cleaned = ", ".join(f"{sql} AS {name}" for name, sql in CLEANED["customers"])
    changed = " OR ".join(f"LAG({c}) OVER w IS DISTINCT FROM {c}" for c in CUST_PAYLOAD)
    cols = ", ".join(CUST_PAYLOAD)
    return f"""{with_ctes(FIXTURE, ranked_cte("customers"))},
      delivered AS (SELECT customer_id, LEAST(rank, 4) AS delivery, rank, {cleaned} FROM ranked_customers WHERE customer_id IS NOT NULL),
      last_of AS (SELECT * FROM delivered QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id, delivery ORDER BY rank DESC) = 1),
      versions AS (SELECT *, ROW_NUMBER() OVER w = 1 OR {changed} AS opens FROM last_of WINDOW w AS (PARTITION BY customer_id ORDER BY delivery))
      SELECT customer_id, {cols}, delivery::INTEGER AS opened,
             (LEAD(delivery) OVER (PARTITION BY customer_id ORDER BY delivery))::INTEGER AS closed
      FROM (SELECT * FROM versions WHERE opens)"""


def catalog_sql() -> str:
    def lit(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    meta = " UNION ALL ".join(
        f"SELECT {lit(name)} AS dataset, {lit(layer)} AS layer, {lit(kind)} AS kind, "
        f"{lit(comment)} AS comment, {lit(key)} AS cluster_key"
        for name, layer, kind, comment, key in EXPECTED_CATALOG
    )
    counts = f"""
      SELECT 'bronze_customers' AS dataset, COUNT(*) AS row_count FROM raw_customers
      UNION ALL SELECT 'bronze_orders', COUNT(*) FROM raw_orders
      UNION ALL SELECT 'bronze_line_items', COUNT(*) FROM raw_line_items
      UNION ALL SELECT 'silver_customers', COUNT(*) FROM silver_customers
      UNION ALL SELECT 'silver_orders', COUNT(*) FROM silver_orders
      UNION ALL SELECT 'silver_line_items', COUNT(*) FROM silver_line_items
      UNION ALL SELECT 'dim_customers', COUNT(DISTINCT customer_id) FROM silver_customers
      UNION ALL SELECT 'fact_orders', COUNT(*) FROM fact_orders
      UNION ALL SELECT 'fact_line_items', COUNT(*) FROM fact_line_items
      UNION ALL SELECT 'gold_sales_by_region_monthly', COUNT(*) FROM ({M1})
      UNION ALL SELECT 'gold_product_sales_metrics', COUNT(*) FROM ({M2})"""
    return f"{BASE}, meta AS ({meta}), counts AS ({counts}) SELECT m.*, c.row_count FROM meta m JOIN counts c USING (dataset)"


def oracle_sql() -> dict[str, str]:
    b = BASE
    return {
        "ingest_json_customers": ingest_sql("customers"),
        "ingest_json_orders": ingest_sql("orders"),
        "ingest_json_line_items": ingest_sql("line_items"),
        "ingest_rescued_data": rescued_union_sql(),
        "stream_incremental_silver": f"{with_ctes(FIXTURE, SILVER)} SELECT {LINE_COLS} FROM silver_line_items",
        "dataset_catalog": catalog_sql(),
        "clustered_write": f"{with_ctes(FIXTURE, SILVER)} SELECT * FROM silver_line_items",
        "clustered_tables": clustered_sql(),
        "ingest_bounded_batches": f"{ingest_sql('line_items', lineage=False)}",
        "silver_customers": f"{with_ctes(FIXTURE, SILVER)} SELECT * FROM silver_customers",
        "silver_orders": f"{with_ctes(FIXTURE, SILVER)} SELECT * FROM silver_orders",
        "silver_line_items": f"{with_ctes(FIXTURE, SILVER)} SELECT * FROM silver_line_items",
        "scd1_orders": f"{b} SELECT * FROM fact_orders",
        "scd1_line_items": f"{b} SELECT * FROM fact_line_items",
        "scd2_history": f"{b} SELECT * FROM dim_customers",
        "scd2_current_rows": f"{b} SELECT * FROM dim_customers WHERE __END_AT IS NULL",
        "scd2_noop_suppressed": f"{b} SELECT * FROM dim_customers",
        "scd2_late_arrival": f"{b} SELECT * FROM dim_customers",
        "scd2_skewed_key": skewed_sql(),
        "cdc_apply_late_arrival": late_sql(),
        "pipeline_scd2_incremental": incremental_history_sql(),
        "scd_tie_break": tie_break_sql(),
        "join_orders_current_customers": f"""{b}
            SELECT o.customer_id, o.order_id, o.order_date, o.order_year, o.order_month, o.total_amount,
                   o.status, o.is_valid, c.region, c.membership_level
            FROM fact_orders o JOIN dim_customers c ON o.customer_id = c.customer_id AND c.__END_AT IS NULL""",
        "join_line_items_orders": f"""{b}
            SELECT li.order_id, li.line_item_id, li.product_name, li.quantity, li.unit_price, li.line_total,
                   li.is_valid, o.customer_id, o.order_date, o.status, o.is_valid AS order_is_valid
            FROM fact_line_items li JOIN fact_orders o ON li.order_id = o.order_id""",
        "agg_count_distinct": f"""{b}
            SELECT product_name, COUNT(DISTINCT order_id) AS distinct_orders
            FROM fact_line_items GROUP BY product_name""",
        "agg_conditional": f"""{b}
            SELECT order_year, order_month,
              {cents('total_amount', "state = 'd'")} AS delivered_revenue, COUNT(*) FILTER (state = 'd') AS delivered_order_count,
              {cents('total_amount', "state = 's'")} AS shipped_revenue, COUNT(*) FILTER (state = 's') AS shipped_order_count,
              {cents('total_amount', "state = 'o'")} AS other_revenue, COUNT(*) FILTER (state = 'o') AS other_order_count
            FROM (SELECT *, COALESCE(MAP {{'DELIVERED': 'd', 'SHIPPED': 's'}}[status], CASE WHEN status IS NOT NULL THEN 'o' END) AS state
                  FROM fact_orders WHERE is_valid)
            GROUP BY order_year, order_month""",
        "agg_conditional_distinct": f"""{b}
            SELECT product_name, COUNT(*) FILTER (status = 'DELIVERED') AS delivered_order_count,
              COUNT(*) FILTER (status = 'SHIPPED') AS shipped_order_count
            FROM (SELECT DISTINCT product_name, order_id, status
                  FROM fact_line_items JOIN (SELECT order_id, status FROM fact_orders) USING (order_id))
            GROUP BY product_name""",
        "mv_sales_by_region_monthly": f"{b} {M1}",
        "mv_product_sales_metrics": f"{b} {M2}",
        "pipeline_end_to_end": f"{b} {M1}",
        "pipeline_selective_refresh": f"{b} {M2}",
    }
