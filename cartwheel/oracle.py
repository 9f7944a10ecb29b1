"""Independent DuckDB formulations of every registered query.

Written directly as SQL over the pre-registered test-table views, with the
fixture (F1/F2), marts and questions re-stated in DuckDB's dialect.  Cross-
engine notes:
  * DuckDB ``dayofweek`` has Sunday = 0 (Spark: Sunday = 1).
  * DuckDB ``sum`` of integers is HUGEINT -> cast to BIGINT.
  * Spark rounds a double half-up on its shortest decimal form; DuckDB rounds
    the binary value.  ``R2`` rounds through DECIMAL(38,9) to match.
  * DuckDB sorts NULLs last by default; tie-breaks state NULLS FIRST where
    Spark's ascending default applies.
"""

from __future__ import annotations


def R2(x: str) -> str:  # noqa: N802 - reads like the SQL function it stands for
    return f"CAST(round(CAST(({x}) AS DECIMAL(38, 9)), 2) AS DOUBLE)"


def PCT(x: str) -> str:  # noqa: N802
    return R2(f"({x}) * CAST(100.0 AS DOUBLE)")


# Labels and columns of the results.


DAY_CASE = """CASE {c}
        WHEN 0 THEN 'Sunday' WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday'
        WHEN 3 THEN 'Wednesday' WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday'
        WHEN 6 THEN 'Saturday' ELSE 'Unknown' END"""

ITEMS_CTE = """
seq AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
           row_number() OVER w AS order_number,
           lag(o_orderdate) OVER w AS prev_date
    FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
),
base AS (
    SELECT s.o_orderkey AS order_id,
           s.o_custkey AS user_id,
           CAST(s.order_number AS INTEGER) AS order_number,
           CAST(dayofweek(s.o_orderdate) AS INTEGER) AS order_dow,
           CAST(s.o_orderkey % 24 AS INTEGER) AS order_hour_of_day,
           CAST(date_diff('day', CAST(s.prev_date AS DATE), CAST(s.o_orderdate AS DATE)) AS DOUBLE)
               AS days_since_prior_order,
           s.o_orderstatus AS eval_set,
           l.l_partkey AS product_id,
           p.p_name AS product_name,
           CAST(list_position(['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'], p.p_type)
                AS INTEGER) AS aisle_id,
           p.p_type AS aisle,
           CASE WHEN l.l_partkey % 50 = 0 THEN NULL
                ELSE TRY_CAST(split_part(p.p_brand, '#', 2) AS INTEGER) END AS department_id,
           CASE WHEN l.l_partkey % 50 = 0 THEN '' ELSE p.p_brand END AS department,
           l.l_linenumber AS add_to_cart_order
    FROM seq s
    LEFT JOIN lineitem l ON l.l_orderkey = s.o_orderkey
    LEFT JOIN part p ON p.p_partkey = l.l_partkey
),
firsts AS (
    SELECT user_id, product_name, min(order_number) AS first_number
    FROM base WHERE product_id IS NOT NULL
    GROUP BY user_id, product_name
),
items AS (
    SELECT b.order_id, b.user_id, b.order_number, b.order_dow, b.order_hour_of_day,
           b.days_since_prior_order,
           coalesce(b.eval_set, '') AS eval_set,
           b.product_id,
           coalesce(b.product_name, '') AS product_name,
           b.aisle_id,
           coalesce(b.aisle, '') AS aisle,
           b.department_id,
           coalesce(b.department, '') AS department,
           b.add_to_cart_order,
           CAST(CASE WHEN b.product_id IS NULL OR b.order_number = 1 THEN NULL
                     WHEN f.first_number < b.order_number THEN 1 ELSE 0 END AS INTEGER) AS reordered,
           TIMESTAMP '2024-01-01 00:00:00.123' AS ingested_at
    FROM base b
    LEFT JOIN firsts f
      ON f.user_id = b.user_id AND f.product_name IS NOT DISTINCT FROM b.product_name
),
lines AS (SELECT * FROM items WHERE product_id IS NOT NULL)"""

PRODUCT_CTE = f"""
product_all AS (
    SELECT product_id, product_name, aisle, department,
           count(*) AS total_order_lines,
           count(DISTINCT order_id) AS unique_orders,
           CAST(sum(coalesce(reordered, 0)) AS BIGINT) AS reordered_count,
           avg(coalesce(reordered, 0)) AS reorder_rate,
           avg(add_to_cart_order) AS avg_add_to_cart_order
    FROM lines
    GROUP BY product_id, product_name, aisle, department
),
product AS (
    SELECT * FROM product_all
    ORDER BY total_order_lines DESC, product_id, product_name, aisle, department
    LIMIT 100
)"""

DEPARTMENT_CTE = """
department_mart AS (
    SELECT coalesce(department_id, 0) AS department_id,
           CASE WHEN department = '' THEN 'unknown' ELSE department END AS department,
           count(*) AS total_order_lines,
           count(DISTINCT order_id) AS unique_orders,
           count(DISTINCT product_id) AS unique_products,
           CAST(sum(coalesce(reordered, 0)) AS BIGINT) AS reordered_count,
           avg(coalesce(reordered, 0)) AS reorder_rate
    FROM lines
    GROUP BY 1, 2
)"""

HOURLY_CTE = """
hourly AS (
    SELECT order_dow, order_hour_of_day,
           count(DISTINCT order_id) AS total_orders,
           count(*) AS total_order_lines,
           count(DISTINCT user_id) AS unique_users,
           CASE WHEN count(DISTINCT order_id) = 0 THEN NULL
                ELSE CAST(count(*) AS DOUBLE) / count(DISTINCT order_id) END AS avg_items_per_order
    FROM items
    GROUP BY order_dow, order_hour_of_day
)"""

BASKET_CTE = """
basket AS (
    SELECT order_id, min(order_dow) AS order_dow, count(*) AS basket_size
    FROM lines
    GROUP BY order_id
)"""

EDITS_CTE = """
edits AS (
    SELECT event_id AS edit_id,
           'page_' || CAST(user_id AS VARCHAR) AS title,
           CAST(user_id AS VARCHAR) AS "user",
           event_type = 'error' AS is_bot,
           abs(coalesce(CAST(floor(value * 100) AS BIGINT), 0)
               - coalesce(TRY_CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT), 0)) AS size_diff
    FROM events
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _items_sql(body: str, *extra: str) -> str:
    return _with(ITEMS_CTE, *extra) + "\n" + body


RATIO = "CAST(count(*) AS DOUBLE) / count(DISTINCT order_id)"

# Labels and columns of the results.

ORDER_NUMBER_CASE = """CASE
        WHEN order_number = 1 THEN '01. First Order'
        WHEN order_number BETWEEN 2 AND 5 THEN '02. Order 2-5'
        WHEN order_number BETWEEN 6 AND 10 THEN '03. Order 6-10'
        WHEN order_number BETWEEN 11 AND 20 THEN '04. Order 11-20'
        WHEN order_number BETWEEN 21 AND 50 THEN '05. Order 21-50'
        ELSE '06. Order 51+' END"""

# Labels and columns of the results.

DAYS_CASE = """CASE
        WHEN days_since_prior_order IS NULL THEN 'Unknown / First Order'
        WHEN days_since_prior_order = 0 THEN 'Same Day'
        WHEN days_since_prior_order BETWEEN 1 AND 3 THEN '1-3 Days'
        WHEN days_since_prior_order BETWEEN 4 AND 7 THEN '4-7 Days'
        WHEN days_since_prior_order BETWEEN 8 AND 14 THEN '8-14 Days'
        WHEN days_since_prior_order BETWEEN 15 AND 30 THEN '15-30 Days'
        ELSE '30+ Days' END"""

# Labels and columns of the results.

ITEM_COLS = ("order_id, user_id, order_number, order_dow, order_hour_of_day, "
             "days_since_prior_order, eval_set, product_id, product_name, aisle_id, aisle, "
             "department_id, department, add_to_cart_order, reordered, ingested_at")


def _q01_body(select: str) -> str:
    return _items_sql(f"SELECT {select} FROM lines")


def build() -> dict[str, str]:
    reorder_pct = PCT("avg(coalesce(reordered, 0))")
    sql: dict[str, str] = {}

    sql["order_items"] = _items_sql(f"SELECT {ITEM_COLS} FROM items")
    sql["product_lines"] = _items_sql(f"SELECT {ITEM_COLS} FROM lines")
    sql["product_summary"] = _items_sql("SELECT * FROM product", PRODUCT_CTE)
    sql["department_summary"] = _items_sql("SELECT * FROM department_mart", DEPARTMENT_CTE)
    sql["hourly_summary"] = _items_sql("SELECT * FROM hourly", HOURLY_CTE)
    sql["edits_trending"] = _with(EDITS_CTE) + """
SELECT title, count(edit_id) AS total_edits,
       CAST(sum(size_diff) AS BIGINT) AS total_bytes_changed,
       CAST(sum(CASE WHEN is_bot THEN 1 ELSE 0 END) AS BIGINT) AS bot_edits
FROM edits GROUP BY title
ORDER BY total_edits DESC, title NULLS FIRST
LIMIT 30"""

    sql["q01_kpi_summary"] = _q01_body(f"""
    count(DISTINCT order_id) AS total_orders,
    count(DISTINCT user_id) AS total_users,
    count(*) AS total_order_lines,
    count(DISTINCT product_id) AS total_unique_products,
    {R2(RATIO)} AS avg_items_per_order,
    {reorder_pct} AS reorder_rate_percent""")
    sql["q01a_total_orders"] = _q01_body("count(DISTINCT order_id) AS total_orders")
    sql["q01b_total_users"] = _q01_body("count(DISTINCT user_id) AS total_users")
    sql["q01c_total_order_lines"] = _q01_body("count(*) AS total_order_lines")
    sql["q01d_unique_products"] = _q01_body("count(DISTINCT product_id) AS total_unique_products")
    sql["q01e_avg_items"] = _q01_body(f"{R2(RATIO)} AS avg_items_per_order")
    sql["q01f_reorder_rate"] = _q01_body(f"{reorder_pct} AS reorder_rate_percent")
    sql["q16_reorder_gauge"] = sql["q01f_reorder_rate"]

    tie = "product_id, product_name, aisle, department"
    sql["q02_top_products"] = _items_sql(f"""
SELECT product_name, department, aisle, total_order_lines, unique_orders,
       {PCT('reorder_rate')} AS reorder_rate_percent,
       {R2('avg_add_to_cart_order')} AS avg_add_to_cart_order
FROM product
ORDER BY total_order_lines DESC, {tie}
LIMIT 15""", PRODUCT_CTE)
    sql["q03_loyal_products"] = _items_sql(f"""
SELECT product_name, department, aisle, total_order_lines, reordered_count,
       {PCT('reorder_rate')} AS reorder_rate_percent
FROM product
WHERE total_order_lines >= 3
ORDER BY reorder_rate DESC, total_order_lines DESC, {tie}
LIMIT 15""", PRODUCT_CTE)
    sql["q13_cart_position"] = _items_sql(f"""
SELECT product_name, department, total_order_lines,
       {R2('avg_add_to_cart_order')} AS avg_add_to_cart_order,
       {PCT('reorder_rate')} AS reorder_rate_percent
FROM product
WHERE total_order_lines >= 3
ORDER BY {R2('avg_add_to_cart_order')} ASC NULLS LAST, total_order_lines DESC, {tie}
LIMIT 15""", PRODUCT_CTE)
    sql["q20_top10_products"] = _items_sql(f"""
SELECT product_name, department, total_order_lines
FROM product
ORDER BY total_order_lines DESC, {tie}
LIMIT 10""", PRODUCT_CTE)

    sql["q04_department_share"] = _items_sql(f"""
SELECT department, total_order_lines, unique_orders, unique_products,
       {R2('total_order_lines * CAST(100.0 AS DOUBLE) / sum(total_order_lines) OVER ()')}
           AS share_of_order_lines_percent,
       {PCT('reorder_rate')} AS reorder_rate_percent
FROM department_mart
ORDER BY total_order_lines DESC, department""", DEPARTMENT_CTE)
    sql["q05_department_matrix"] = _items_sql(f"""
SELECT department, total_order_lines, unique_orders, unique_products,
       {PCT('reorder_rate')} AS reorder_rate_percent
FROM department_mart
ORDER BY total_order_lines DESC, department""", DEPARTMENT_CTE)

    sql["q06_traffic_by_hour"] = _items_sql(f"""
SELECT order_hour_of_day,
       CAST(sum(total_orders) AS BIGINT) AS total_orders,
       CAST(sum(total_order_lines) AS BIGINT) AS total_order_lines,
       {R2('CAST(sum(total_order_lines) AS DOUBLE) / sum(total_orders)')} AS avg_items_per_order
FROM hourly
GROUP BY order_hour_of_day
ORDER BY order_hour_of_day""", HOURLY_CTE)
    sql["q07_day_hour"] = _items_sql(f"""
SELECT order_dow, {DAY_CASE.format(c='order_dow')} AS day_name,
       order_hour_of_day, total_orders, total_order_lines,
       {R2('avg_items_per_order')} AS avg_items_per_order
FROM hourly
ORDER BY order_dow, order_hour_of_day""", HOURLY_CTE)
    sql["q19_peak_hours"] = _items_sql("""
SELECT order_hour_of_day, CAST(sum(total_orders) AS BIGINT) AS total_orders
FROM hourly
GROUP BY order_hour_of_day
ORDER BY order_hour_of_day""", HOURLY_CTE)
    sql["x_orders_by_day"] = _items_sql(f"""
SELECT order_dow, {DAY_CASE.format(c='order_dow')} AS day_name,
       CAST(sum(total_orders) AS BIGINT) AS total_orders,
       CAST(sum(total_order_lines) AS BIGINT) AS total_order_lines,
       {R2('CAST(sum(total_order_lines) AS DOUBLE) / sum(total_orders)')} AS avg_items_per_order
FROM hourly
GROUP BY order_dow
ORDER BY order_dow""", HOURLY_CTE)
    pivot_cols = ",\n       ".join(
        f'CAST(sum(CASE WHEN order_hour_of_day = {h} THEN total_orders END) AS BIGINT) AS "{h}"'
        for h in range(24))
    sql["x_day_hour_pivot"] = _items_sql(f"""
SELECT order_dow,
       {pivot_cols},
       CAST(sum(CASE WHEN coalesce(order_hour_of_day NOT BETWEEN 0 AND 23, true) THEN total_orders END) AS BIGINT) AS "other"
FROM hourly
GROUP BY order_dow
ORDER BY order_dow""", HOURLY_CTE)

    sql["q08_basket_histogram"] = _items_sql("""
SELECT basket_size, count(*) AS total_orders
FROM basket
GROUP BY basket_size
ORDER BY basket_size""", BASKET_CTE)
    sql["q09_reorder_split"] = _items_sql(f"""
SELECT CASE WHEN coalesce(reordered, 0) = 1 THEN 'Reordered' ELSE 'First-time' END
           AS product_line_type,
       count(*) AS total_order_lines,
       {R2('count(*) * CAST(100.0 AS DOUBLE) / sum(count(*)) OVER ()')} AS percentage
FROM lines
GROUP BY 1
ORDER BY total_order_lines DESC, product_line_type""")
    sql["q10_rate_by_order_number"] = _items_sql(f"""
SELECT {ORDER_NUMBER_CASE} AS order_number_bucket,
       count(DISTINCT order_id) AS total_orders,
       count(*) AS total_order_lines,
       {reorder_pct} AS reorder_rate_percent
FROM lines
GROUP BY 1
ORDER BY 1""")
    sql["q11_days_since_prior"] = _items_sql(f"""
SELECT {DAYS_CASE} AS days_since_prior_order_bucket,
       count(DISTINCT order_id) AS total_orders,
       count(*) AS total_order_lines,
       {reorder_pct} AS reorder_rate_percent
FROM lines
GROUP BY 1
ORDER BY list_position(['Unknown / First Order', 'Same Day', '1-3 Days', '4-7 Days',
                        '8-14 Days', '15-30 Days', '30+ Days'], days_since_prior_order_bucket)""")
    sql["q12_top_aisles"] = _items_sql(f"""
SELECT department, aisle,
       count(*) AS total_order_lines,
       count(DISTINCT order_id) AS unique_orders,
       count(DISTINCT product_id) AS unique_products,
       {reorder_pct} AS reorder_rate_percent
FROM lines
GROUP BY department, aisle
ORDER BY total_order_lines DESC, department, aisle
LIMIT 25""")
    sql["q14_user_frequency"] = _items_sql(f"""
SELECT user_id,
       count(DISTINCT order_id) AS total_orders,
       count(*) AS total_order_lines,
       count(DISTINCT product_id) AS unique_products,
       {reorder_pct} AS reorder_rate_percent,
       {R2(RATIO)} AS avg_items_per_order
FROM lines
GROUP BY user_id
ORDER BY total_orders DESC, total_order_lines DESC, user_id
LIMIT 20""")
    sql["q15_freshness"] = _items_sql("""
SELECT date_trunc('second', max(ingested_at)) AS latest_ingested_at,
       date_trunc('second', min(ingested_at)) AS earliest_ingested_at,
       count(DISTINCT order_id) AS total_orders_in_current_load,
       count(*) AS total_order_lines_in_current_load
FROM items""")
    sql["q17_department_aisle_flow"] = _items_sql("""
SELECT department AS source, aisle AS target, count(*) AS total_order_lines
FROM lines
GROUP BY department, aisle
ORDER BY total_order_lines DESC, source, target
LIMIT 30""")
    sql["q18_basket_by_day"] = _items_sql(f"""
SELECT {DAY_CASE.format(c='order_dow')} AS day_name, basket_size
FROM basket
ORDER BY day_name, basket_size""", BASKET_CTE)
    sql["x_basket_box"] = _items_sql(f"""
SELECT {DAY_CASE.format(c='order_dow')} AS day_name,
       count(*) AS total_orders,
       quantile_cont(CAST(basket_size AS DOUBLE), 0.0) AS min_basket_size,
       quantile_cont(CAST(basket_size AS DOUBLE), 0.25) AS q1_basket_size,
       quantile_cont(CAST(basket_size AS DOUBLE), 0.5) AS median_basket_size,
       quantile_cont(CAST(basket_size AS DOUBLE), 0.75) AS q3_basket_size,
       quantile_cont(CAST(basket_size AS DOUBLE), 1.0) AS max_basket_size
FROM basket
GROUP BY 1
ORDER BY 1""", BASKET_CTE)

    sql["v_row_counts"] = _items_sql("""
SELECT 'orders_order_items' AS table_name, count(*) AS total_rows FROM items
UNION ALL
SELECT 'orders_product_summary', count(*) FROM product
UNION ALL
SELECT 'orders_department_summary', count(*) FROM department_mart
UNION ALL
SELECT 'orders_hourly_summary', count(*) FROM hourly""", PRODUCT_CTE, DEPARTMENT_CTE, HOURLY_CTE)
    order_all = ", ".join(f"{c.strip()} NULLS FIRST" for c in ITEM_COLS.split(","))
    sql["v_sample"] = _items_sql(f"SELECT {ITEM_COLS} FROM items ORDER BY {order_all} LIMIT 20")
    not_null = {
        "orders_order_items": ("items", ["order_id", "user_id", "order_number", "order_dow",
                                         "order_hour_of_day", "eval_set", "ingested_at"]),
        "orders_product_summary": ("product", ["product_id", "product_name", "aisle", "department",
                                               "total_order_lines", "unique_orders",
                                               "reordered_count", "reorder_rate",
                                               "avg_add_to_cart_order"]),
        "orders_department_summary": ("department_mart", ["department_id", "department",
                                                          "total_order_lines", "unique_orders",
                                                          "unique_products", "reordered_count",
                                                          "reorder_rate"]),
        "orders_hourly_summary": ("hourly", ["order_dow", "order_hour_of_day", "total_orders",
                                             "total_order_lines", "unique_users",
                                             "avg_items_per_order"]),
    }
    null_parts = [f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
                  f"count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM {view}"
                  for t, (view, cols) in not_null.items() for c in cols]
    sql["v_null_checks"] = _items_sql("\nUNION ALL\n".join(null_parts),
                                      PRODUCT_CTE, DEPARTMENT_CTE, HOURLY_CTE)
    # Round trips and refreshes must reproduce the table they rebuild.
    sql["ingest_orders_json"] = sql["order_items"]
    sql["ingest_edits_json"] = sql["edits_trending"]
    sql["stream_refresh"] = sql["order_items"]
    sql["snapshot_counts"] = sql["v_row_counts"]
    sql["stream_edits"] = sql["edits_trending"]
    return sql


ORACLE_SQL = build()
