"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each statement starts from the pre-registered base tables, rebuilds the entity
views (FIXTURES.md section A) and the gold tables in plain SQL, and selects the
same columns, with the same names and types, as the Spark query.
"""

from __future__ import annotations

ADAPTERS = """
order_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
         l_shipdate AS shipping_limit_date,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS freight_value
  FROM lineitem),
orders_src AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
         o_orderdate AS order_purchase_timestamp,
         o_orderdate + INTERVAL 1 DAY AS order_approved_at,
         o_orderdate + INTERVAL 2 DAY AS order_delivered_carrier_date,
         CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate + to_days(CAST(o_orderkey % 40 AS INTEGER)) END
           AS order_delivered_customer_date,
         o_orderdate + INTERVAL 20 DAY AS order_estimated_delivery_date
  FROM orders),
customers AS (
  SELECT c_custkey AS customer_id, concat('u', CAST(c_custkey % 1000 AS VARCHAR)) AS customer_unique_id,
         c_nationkey AS customer_zip_code_prefix, n_name AS customer_city, nullif(r_name, 'ASIA') AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
sellers AS (
  SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code_prefix, n_name AS seller_city, r_name AS seller_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
products AS (
  SELECT p_partkey AS product_id, lower(trim(nullif(p_type, 'PROMO'))) AS product_category_name FROM part),
category_translation AS (
  SELECT * FROM (VALUES ('economy','economy_en'), ('standard','standard_en'), ('medium','medium_en'), ('large','large_en'))
    AS t(product_category_name, product_category_name_english)),
payments AS (
  SELECT o_orderkey AS order_id, 1 AS payment_sequential, o_orderpriority AS payment_type,
         CAST(o_orderkey % 12 + 1 AS INT) AS payment_installments, CAST(o_totalprice AS DECIMAL(18,2)) AS payment_value
  FROM orders),
reviews AS (
  SELECT event_id AS review_id, event_id AS order_id,
         CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE CAST(event_id % 5 + 1 AS VARCHAR) END AS review_score,
         event_type AS review_comment_title, props AS review_comment_message,
         ts AS review_creation_date, ts AS review_answer_timestamp
  FROM events),
geolocation AS (
  SELECT c_nationkey AS zip, n_name AS city, r_name AS state
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def half_up_avg(x: str) -> str:
    """round(avg(x), 2) half away from zero, computed on integer cents."""
    s = f"sum(CAST({x} * 100 AS BIGINT))"
    return (
        f"CAST(sign({s}) * ((2 * abs({s}) + count({x})) // (2 * nullif(count({x}), 0))) AS DOUBLE) / 100"
    )


def mean(x: str) -> str:
    return f"CAST(sum({x}) AS DOUBLE) / nullif(count({x}), 0)"


def title(x: str) -> str:
    """Python str.title(): capitalise every run of letters."""
    return (
        f"array_to_string(list_transform(regexp_extract_all(lower({x}), '\\p{{L}}+|[^\\p{{L}}]+'), "
        f"lambda w: upper(w[1]) || lower(w[2:])), '')"
    )


GOLD = f"""
order_metrics AS (
  SELECT order_id, round(sum(price), 2) AS total_order_value, round(sum(freight_value), 2) AS total_freight,
         count(order_item_id) AS item_count
  FROM order_items GROUP BY order_id),
fact_orders AS (
  SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp, o.order_approved_at,
         o.order_delivered_carrier_date, o.order_delivered_customer_date, o.order_estimated_delivery_date,
         m.total_order_value, m.total_freight, m.item_count
  FROM orders_src o LEFT JOIN order_metrics m ON o.order_id = m.order_id),
fact_orders_inner AS (
  SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp,
         m.total_order_value, m.total_freight, m.item_count
  FROM orders_src o JOIN order_metrics m ON o.order_id = m.order_id),
fact_order_items AS (
  SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value,
         round(price + freight_value, 2) AS item_revenue
  FROM order_items),
fact_payments AS (
  SELECT order_id, payment_sequential, payment_type, payment_installments, payment_value FROM payments),
fact_reviews AS (
  SELECT review_id, order_id, review_score, review_comment_title, review_comment_message,
         review_creation_date, review_answer_timestamp FROM reviews),
dim_customers AS (
  SELECT DISTINCT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state FROM customers),
dim_sellers AS (
  SELECT DISTINCT seller_id, seller_zip_code_prefix, seller_city, seller_state FROM sellers),
dim_products AS (
  SELECT product_category_name, product_id, product_category_name_english FROM (
    SELECT p.product_category_name, p.product_id, t.product_category_name_english,
           row_number() OVER (PARTITION BY p.product_id
             ORDER BY p.product_category_name ASC NULLS FIRST, t.product_category_name_english ASC NULLS FIRST) AS rn
    FROM products p LEFT JOIN category_translation t ON p.product_category_name = t.product_category_name)
  WHERE rn = 1),
sales_by_product AS (
  SELECT product_id, count(order_item_id) AS units_sold, round(sum(price), 2) AS product_revenue,
         {half_up_avg('price')} AS average_price, round(sum(freight_value), 2) AS total_freight
  FROM order_items GROUP BY product_id),
sales_by_seller AS (
  SELECT seller_id, count(order_item_id) AS items_sold, count(order_id) AS orders_handled,
         round(sum(price), 2) AS seller_revenue, round(sum(freight_value), 2) AS seller_freight,
         count(DISTINCT order_id) AS distinct_orders
  FROM order_items GROUP BY seller_id),
category_products AS (
  SELECT p.product_id, p.product_category_name, t.product_category_name_english
  FROM products p LEFT JOIN category_translation t ON p.product_category_name = t.product_category_name),
sales_by_category AS (
  SELECT c.product_category_name, c.product_category_name_english, count(i.order_item_id) AS units_sold,
         round(sum(i.price), 2) AS category_revenue, {half_up_avg('i.price')} AS average_price
  FROM order_items i LEFT JOIN category_products c ON i.product_id = c.product_id
  GROUP BY c.product_category_name, c.product_category_name_english),
product_labels AS (
  SELECT product_id, coalesce(product_category_name_english, substr(CAST(product_id AS VARCHAR), 1, 12)) AS product_label
  FROM dim_products),
seller_label_lookup AS (
  SELECT seller_id, min({title("coalesce(CAST(seller_city AS VARCHAR), '')")} || ', ' ||
                        upper(coalesce(CAST(seller_state AS VARCHAR), ''))) AS seller_label
  FROM dim_sellers WHERE seller_id IS NOT NULL GROUP BY seller_id),
product_category AS (
  SELECT product_id, min(product_category_name_english) AS category FROM dim_products GROUP BY product_id),
scored_reviews AS (
  SELECT *, TRY_CAST(review_score AS DOUBLE) AS score FROM fact_reviews)"""

PRELUDE = "WITH " + ADAPTERS.strip() + "," + GOLD


def q(body: str) -> str:
    return PRELUDE + "\n" + body.strip()


def _money_cols(cols: list[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


ORACLE: dict[str, str] = {}

ORACLE["order_metrics"] = q(
    f"SELECT order_id, {_money_cols(['total_order_value', 'total_freight'])}, item_count FROM order_metrics")
ORACLE["fact_orders"] = q(
    "SELECT order_id, customer_id, order_status, order_purchase_timestamp, order_approved_at, "
    "order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date, "
    f"{_money_cols(['total_order_value', 'total_freight'])}, CAST(item_count AS DOUBLE) AS item_count FROM fact_orders")
ORACLE["fact_orders_inner"] = q(
    "SELECT order_id, customer_id, order_status, order_purchase_timestamp, "
    f"{_money_cols(['total_order_value', 'total_freight'])}, item_count FROM fact_orders_inner")
ORACLE["fact_order_items"] = q(
    "SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, "
    f"{_money_cols(['price', 'freight_value', 'item_revenue'])} FROM fact_order_items")
ORACLE["fact_payments"] = q(
    "SELECT order_id, payment_sequential, payment_type, payment_installments, "
    "CAST(payment_value AS DOUBLE) AS payment_value FROM fact_payments")
ORACLE["fact_reviews"] = q("SELECT * FROM fact_reviews")
ORACLE["dim_customers"] = q("SELECT * FROM dim_customers")
ORACLE["dim_products"] = q("SELECT * FROM dim_products")
ORACLE["dim_sellers"] = q("SELECT * FROM dim_sellers")
ORACLE["sales_by_product"] = q(
    "SELECT product_id, units_sold, CAST(product_revenue AS DOUBLE) AS product_revenue, average_price, "
    "CAST(total_freight AS DOUBLE) AS total_freight FROM sales_by_product")
ORACLE["sales_by_seller"] = q(
    "SELECT seller_id, items_sold, orders_handled, "
    f"{_money_cols(['seller_revenue', 'seller_freight'])}, distinct_orders FROM sales_by_seller")
ORACLE["sales_by_category"] = q(
    "SELECT product_category_name, product_category_name_english, units_sold, "
    "CAST(category_revenue AS DOUBLE) AS category_revenue, average_price FROM sales_by_category")
ORACLE["product_labels"] = q("""
SELECT s.product_id, s.units_sold, CAST(s.product_revenue AS DOUBLE) AS product_revenue, s.average_price,
       CAST(s.total_freight AS DOUBLE) AS total_freight,
       coalesce(l.product_label, substr(CAST(s.product_id AS VARCHAR), 1, 12)) AS product_label
FROM sales_by_product s LEFT JOIN product_labels l ON s.product_id = l.product_id""")
ORACLE["seller_labels"] = q("""
SELECT s.seller_id, s.items_sold, s.orders_handled, CAST(s.seller_revenue AS DOUBLE) AS seller_revenue,
       CAST(s.seller_freight AS DOUBLE) AS seller_freight, s.distinct_orders,
       coalesce(l.seller_label, substr(CAST(s.seller_id AS VARCHAR), 1, 12)) AS seller_label
FROM sales_by_seller s LEFT JOIN seller_label_lookup l ON s.seller_id = l.seller_id""")

KPIS = """
kpi_orders AS (SELECT coalesce(sum(total_order_value), 0) AS revenue, count(DISTINCT order_id) AS orders FROM fact_orders),
kpi_customers AS (SELECT count(DISTINCT customer_id) AS customers FROM dim_customers),
kpi_items AS (SELECT count(*) AS item_records, count(DISTINCT CAST(order_item_id AS VARCHAR)) AS distinct_item_seq
              FROM fact_order_items),
kpis AS (
  SELECT CAST(revenue AS DOUBLE) AS revenue, orders, customers, item_records, distinct_item_seq,
         CASE WHEN orders > 0 THEN CAST(revenue AS DOUBLE) / orders ELSE 0.0 END AS average_order_value,
         revenue AS revenue_dec
  FROM kpi_orders, kpi_customers, kpi_items)"""


def qk(body: str) -> str:
    return PRELUDE + "," + KPIS + "\n" + body.strip()


def money_text(x: str) -> str:
    """Display text for money from integer cents, half-up (mirrors formatting.format_money)."""
    c = f"CAST(CAST({x} AS DECIMAL(18,2)) * 100 AS BIGINT)"
    a = f"abs({c})"
    sign = f"CASE WHEN {c} < 0 THEN '-' ELSE '' END"
    hm = f"((2 * {a} + 1000000) // 2000000)"
    tk = f"((2 * {a} + 10000) // 20000)"
    return (
        f"CASE WHEN {x} IS NULL THEN '—' "
        f"WHEN {a} >= 100000000 THEN '$' || {sign} || CAST({hm} // 100 AS VARCHAR) || '.' || "
        f"lpad(CAST({hm} % 100 AS VARCHAR), 2, '0') || 'M' "
        f"WHEN {a} >= 100000 THEN '$' || {sign} || CAST({tk} // 10 AS VARCHAR) || '.' || CAST({tk} % 10 AS VARCHAR) || 'K' "
        f"ELSE '$' || {sign} || CAST({a} // 100 AS VARCHAR) || '.' || lpad(CAST({a} % 100 AS VARCHAR), 2, '0') END"
    )


def count_text(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '—' ELSE format('{{:,}}', CAST(trunc({x}) AS BIGINT)) END"


ORACLE["executive_kpis"] = qk(
    "SELECT revenue, orders, customers, item_records, distinct_item_seq, average_order_value FROM kpis")
ORACLE["executive_kpi_cards"] = qk(f"""
SELECT {money_text('revenue_dec')} AS revenue_text, {count_text('orders')} AS orders_text,
       {count_text('customers')} AS customers_text, {count_text('distinct_item_seq')} AS items_text,
       {money_text('average_order_value')} AS average_order_text
FROM kpis""")
ORACLE["item_order_consistency"] = qk("""
SELECT distinct_item_seq AS item_count, orders AS order_count,
       (distinct_item_seq > 0 AND distinct_item_seq < orders) AS items_below_orders
FROM kpis""")
ORACLE["monthly_revenue"] = q("""
, monthly AS (
  SELECT CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS m, coalesce(sum(total_order_value), 0) AS revenue
  FROM fact_orders WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1),
spine AS (
  SELECT CAST(unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS DATE) AS m FROM monthly)
SELECT CAST(last_day(s.m) AS TIMESTAMP) AS month, CAST(coalesce(mo.revenue, 0) AS DOUBLE) AS revenue
FROM spine s LEFT JOIN monthly mo ON s.m = mo.m""")
ORACLE["order_status_mix"] = q("""
SELECT coalesce(order_status, 'unknown') AS order_status, count(*) AS count
FROM fact_orders GROUP BY 1 ORDER BY count DESC, order_status""")
ORACLE["order_status_asc"] = q("""
SELECT coalesce(order_status, 'unknown') AS order_status, count(*) AS count
FROM fact_orders GROUP BY 1 ORDER BY count ASC, order_status""")
LABEL_REVENUE = """
, label_revenue AS (
  SELECT coalesce(l.product_label, substr(CAST(i.product_id AS VARCHAR), 1, 12)) AS product_label,
         count(i.product_id) AS units_sold, coalesce(sum(i.price), 0) AS revenue
  FROM fact_order_items i LEFT JOIN product_labels l ON i.product_id = l.product_id
  WHERE i.product_id IS NOT NULL GROUP BY 1),
top_label AS (SELECT * FROM label_revenue ORDER BY revenue DESC, product_label LIMIT 1),
city_customers AS (
  SELECT customer_city, count(DISTINCT customer_id) AS customers FROM dim_customers
  WHERE customer_city IS NOT NULL GROUP BY 1),
top_city AS (SELECT * FROM city_customers ORDER BY customers DESC, customer_city LIMIT 1)"""
ORACLE["top_revenue_label"] = q(LABEL_REVENUE + """
SELECT product_label, units_sold, CAST(revenue AS DOUBLE) AS revenue FROM top_label""")
ORACLE["top_customer_city"] = q(LABEL_REVENUE + "\nSELECT customer_city, customers FROM top_city")
ORACLE["business_insights"] = q(LABEL_REVENUE + """
SELECT 'Top revenue-driving product category: **' || product_label || '**.' AS insight FROM top_label
UNION ALL
SELECT 'Largest customer concentration is in **' || customer_city || '**.' AS insight FROM top_city""")

ORACLE["product_sales_fallback"] = q("""
SELECT product_id, count(*) AS units_sold, CAST(coalesce(sum(price), 0) AS DOUBLE) AS product_revenue
FROM fact_order_items WHERE product_id IS NOT NULL GROUP BY product_id""")
LABELLED_SALES = """
, labelled_sales AS (
  SELECT s.*, coalesce(l.product_label, substr(CAST(s.product_id AS VARCHAR), 1, 12)) AS product_label
  FROM sales_by_product s LEFT JOIN product_labels l ON s.product_id = l.product_id)"""
ORACLE["top_products_by_units"] = q(LABELLED_SALES + """
SELECT product_label, CAST(sum(units_sold) AS BIGINT) AS units_sold FROM labelled_sales WHERE product_label IS NOT NULL
GROUP BY 1 ORDER BY units_sold DESC, product_label LIMIT 15""")
ORACLE["top_products_by_revenue"] = q(LABELLED_SALES + """
SELECT product_label, CAST(sum(product_revenue) AS DOUBLE) AS product_revenue FROM labelled_sales
WHERE product_label IS NOT NULL GROUP BY 1 ORDER BY sum(product_revenue) DESC, product_label LIMIT 15""")
ORACLE["category_performance"] = q("""
SELECT c.category, CAST(sum(s.units_sold) AS BIGINT) AS units_sold, CAST(sum(s.product_revenue) AS DOUBLE) AS revenue
FROM sales_by_product s LEFT JOIN product_category c ON s.product_id = c.product_id
WHERE c.category IS NOT NULL GROUP BY 1 ORDER BY sum(s.product_revenue) DESC, c.category LIMIT 20""")
ORACLE["low_sales_products"] = q("""
SELECT p.product_id, CAST(coalesce(s.units_sold, 0) AS BIGINT) AS units_sold
FROM (SELECT DISTINCT product_id FROM dim_products) p LEFT JOIN sales_by_product s ON p.product_id = s.product_id
ORDER BY units_sold ASC, p.product_id LIMIT 20""")
ORACLE["category_order_volume"] = q(f"""
SELECT c.category, count(DISTINCT i.order_id) AS orders, {half_up_avg('i.price')} AS average_price
FROM fact_order_items i JOIN product_category c ON i.product_id = c.product_id
WHERE c.category IS NOT NULL GROUP BY 1""")

PER_CUSTOMER = """
, per_customer AS (
  SELECT customer_id, sum(total_order_value) AS revenue, count(DISTINCT order_id) AS orders
  FROM fact_orders GROUP BY customer_id),
customer_one AS (
  SELECT customer_id, customer_unique_id, customer_city, customer_state FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY customer_unique_id NULLS FIRST,
      customer_zip_code_prefix NULLS FIRST, customer_city NULLS FIRST, customer_state NULLS FIRST) AS rn
    FROM dim_customers) WHERE rn = 1)"""
ORACLE["customer_kpis"] = q(PER_CUSTOMER + """
, merged AS (SELECT p.customer_id, p.revenue FROM per_customer p LEFT JOIN dim_customers c ON p.customer_id = c.customer_id),
k AS (SELECT count(DISTINCT customer_id) AS active_customers, coalesce(sum(revenue), 0) AS customer_revenue FROM merged)
SELECT active_customers, CAST(customer_revenue AS DOUBLE) AS customer_revenue,
       CASE WHEN active_customers > 0 THEN CAST(customer_revenue AS DOUBLE) / active_customers ELSE 0.0 END
         AS avg_customer_value
FROM k""")
ORACLE["revenue_by_state"] = q(PER_CUSTOMER + """
SELECT c.customer_state, CAST(coalesce(sum(p.revenue), 0) AS DOUBLE) AS revenue
FROM per_customer p LEFT JOIN dim_customers c ON p.customer_id = c.customer_id
WHERE c.customer_state IS NOT NULL GROUP BY 1
ORDER BY coalesce(sum(p.revenue), 0) DESC, c.customer_state LIMIT 15""")
ORACLE["customers_by_city"] = q("""
SELECT customer_city, count(DISTINCT customer_id) AS customers FROM dim_customers WHERE customer_city IS NOT NULL
GROUP BY 1 ORDER BY customers DESC, customer_city LIMIT 20""")
ORACLE["revenue_by_city"] = q(PER_CUSTOMER + """
SELECT c.customer_city, CAST(coalesce(sum(p.revenue), 0) AS DOUBLE) AS revenue
FROM per_customer p JOIN customer_one c ON p.customer_id = c.customer_id
WHERE c.customer_city IS NOT NULL GROUP BY 1""")
ORACLE["orders_by_city"] = q(PER_CUSTOMER + """
SELECT c.customer_city, CAST(sum(p.orders) AS BIGINT) AS orders
FROM per_customer p JOIN customer_one c ON p.customer_id = c.customer_id
WHERE c.customer_city IS NOT NULL GROUP BY 1""")
ORACLE["orders_per_customer"] = q(PER_CUSTOMER + """
, per_person AS (
  SELECT c.customer_unique_id, CAST(sum(p.orders) AS BIGINT) AS orders_placed
  FROM per_customer p JOIN customer_one c ON p.customer_id = c.customer_id GROUP BY 1)
SELECT orders_placed, count(*) AS customers FROM per_person GROUP BY 1""")
ORACLE["customer_value_by_location"] = q(PER_CUSTOMER + """
, s AS (
  SELECT c.customer_state, count(DISTINCT p.customer_id) AS customers, coalesce(sum(p.revenue), 0) AS revenue
  FROM per_customer p JOIN customer_one c ON p.customer_id = c.customer_id
  WHERE c.customer_state IS NOT NULL GROUP BY 1)
SELECT customer_state, customers, CAST(revenue AS DOUBLE) AS revenue,
       CASE WHEN customers > 0 THEN CAST(revenue AS DOUBLE) / customers END AS avg_customer_value
FROM s""")

ORACLE["seller_sales_fallback"] = q("""
SELECT seller_id, count(*) AS items_sold, CAST(coalesce(sum(price), 0) AS DOUBLE) AS seller_revenue
FROM fact_order_items WHERE seller_id IS NOT NULL GROUP BY seller_id""")
SELLER_BY_LABEL = """
, seller_by_label AS (
  SELECT coalesce(l.seller_label, substr(CAST(s.seller_id AS VARCHAR), 1, 12)) AS seller_label,
         sum(s.seller_revenue) AS seller_revenue, CAST(sum(s.items_sold) AS BIGINT) AS items_sold
  FROM sales_by_seller s LEFT JOIN seller_label_lookup l ON s.seller_id = l.seller_id GROUP BY 1)"""
ORACLE["top_sellers_by_revenue"] = q(SELLER_BY_LABEL + """
SELECT seller_label, CAST(seller_revenue AS DOUBLE) AS seller_revenue FROM seller_by_label
WHERE seller_label IS NOT NULL ORDER BY seller_by_label.seller_revenue DESC, seller_label LIMIT 15""")
ORACLE["top_sellers_by_items"] = q(SELLER_BY_LABEL + """
SELECT seller_label, items_sold FROM seller_by_label WHERE seller_label IS NOT NULL
ORDER BY items_sold DESC, seller_label LIMIT 15""")
ORACLE["seller_performance"] = q(SELLER_BY_LABEL + """
SELECT seller_label, CAST(seller_revenue AS DOUBLE) AS seller_revenue, items_sold FROM seller_by_label
WHERE seller_label IS NOT NULL ORDER BY seller_by_label.seller_revenue DESC, seller_label LIMIT 25""")
ORACLE["seller_order_volume"] = q("""
SELECT seller_id, count(DISTINCT order_id) AS orders FROM fact_order_items WHERE seller_id IS NOT NULL GROUP BY 1""")

ORACLE["payment_kpis"] = q(f"""
SELECT CAST(coalesce(sum(payment_value), 0) AS DOUBLE) AS payment_value, count(*) AS payment_records,
       {mean('payment_installments')} AS avg_installments
FROM fact_payments""")
ORACLE["payment_value_by_type"] = q("""
SELECT payment_type, CAST(coalesce(sum(payment_value), 0) AS DOUBLE) AS payment_value
FROM fact_payments WHERE payment_type IS NOT NULL GROUP BY 1""")
ORACLE["payment_usage_by_type"] = q("""
SELECT payment_type, count(*) AS count FROM fact_payments WHERE payment_type IS NOT NULL GROUP BY 1""")
ORACLE["payment_behaviour"] = q(f"""
, g AS (
  SELECT payment_type, payment_installments, count(*) AS payments, {half_up_avg('payment_value')} AS avg_payment_value
  FROM fact_payments WHERE payment_type IS NOT NULL AND payment_installments IS NOT NULL GROUP BY 1, 2)
SELECT payment_type, payment_installments, payments, avg_payment_value,
       CAST(payments AS DOUBLE) / sum(payments) OVER () AS share
FROM g""")

ORACLE["review_kpis"] = q(f"""
SELECT {mean('score')} AS average_rating, count(*) AS review_records, count(score) AS valid_ratings
FROM scored_reviews""")
ORACLE["rating_distribution"] = q("""
SELECT score AS rating, count(*) AS reviews FROM scored_reviews WHERE score IS NOT NULL GROUP BY 1""")
ORACLE["low_rating_reviews"] = q("""
SELECT order_id, score AS review_score, review_comment_message FROM scored_reviews
WHERE score <= 2 ORDER BY score, review_id LIMIT 50""")
ORACLE["review_trend"] = q(f"""
, monthly AS (
  SELECT CAST(date_trunc('month', review_creation_date) AS DATE) AS m, count(*) AS reviews,
         {mean('score')} AS average_rating
  FROM scored_reviews WHERE review_creation_date IS NOT NULL GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS DATE) AS m FROM monthly)
SELECT CAST(last_day(s.m) AS TIMESTAMP) AS month, coalesce(mo.reviews, 0) AS reviews, mo.average_rating
FROM spine s LEFT JOIN monthly mo ON s.m = mo.m""")
ORACLE["poor_review_categories"] = q(f"""
, order_categories AS (
  SELECT DISTINCT i.order_id, c.category FROM fact_order_items i JOIN product_category c ON i.product_id = c.product_id
  WHERE c.category IS NOT NULL),
pairs AS (
  SELECT DISTINCT r.review_id, oc.category, r.score FROM scored_reviews r JOIN order_categories oc ON r.order_id = oc.order_id
  WHERE r.score IS NOT NULL)
SELECT category, count(*) AS reviews, {mean('score')} AS average_rating,
       CAST(count(CASE WHEN score <= 2 THEN 1 END) AS DOUBLE) / count(*) AS low_share
FROM pairs GROUP BY category""")

ORACLE["freight_kpis"] = q(f"""
, k AS (SELECT coalesce(sum(total_freight), 0) AS f, sum(total_order_value) AS r, {mean('total_freight')} AS avg_freight
        FROM fact_orders)
SELECT CAST(f AS DOUBLE) AS total_freight, avg_freight,
       CASE WHEN f <> 0 AND r <> 0 THEN CAST(f AS DOUBLE) / CAST(r AS DOUBLE) * 100.0 END AS freight_to_revenue_pct
FROM k""")
ORACLE["freight_vs_value"] = q("""
SELECT CAST(total_order_value AS DOUBLE) AS total_order_value, CAST(total_freight AS DOUBLE) AS total_freight
FROM fact_orders WHERE total_order_value IS NOT NULL AND total_freight IS NOT NULL ORDER BY order_id LIMIT 5000""")
DELIVERY = """
, d AS (
  SELECT order_id, customer_id, order_delivered_customer_date IS NOT NULL AS delivered,
         order_delivered_customer_date > order_estimated_delivery_date AS late,
         date_diff('day', CAST(order_purchase_timestamp AS DATE), CAST(order_delivered_customer_date AS DATE)) AS days,
         date_diff('day', CAST(order_estimated_delivery_date AS DATE), CAST(order_delivered_customer_date AS DATE))
           AS vs_estimate
  FROM fact_orders)"""
ORACLE["delivery_performance"] = q(DELIVERY + f"""
, k AS (SELECT count(CASE WHEN delivered THEN 1 END) AS delivered_orders, count(CASE WHEN late THEN 1 END) AS late_orders,
               {mean('days')} AS avg_delivery_days, {mean('vs_estimate')} AS avg_days_vs_estimate FROM d)
SELECT delivered_orders, late_orders,
       CASE WHEN delivered_orders > 0 THEN CAST(late_orders AS DOUBLE) / delivered_orders END AS late_rate,
       avg_delivery_days, avg_days_vs_estimate
FROM k""")
ORACLE["delivery_by_location"] = q(PER_CUSTOMER + DELIVERY + """
SELECT c.customer_state, count(CASE WHEN d.delivered THEN 1 END) AS delivered_orders,
       count(CASE WHEN d.late THEN 1 END) AS late_orders,
       CAST(sum(d.days) AS DOUBLE) / nullif(count(d.days), 0) AS avg_delivery_days
FROM d JOIN customer_one c ON d.customer_id = c.customer_id
WHERE c.customer_state IS NOT NULL GROUP BY 1""")
ORACLE["freight_by_order_value"] = q("""
, b AS (
  SELECT CASE WHEN total_order_value >= 1000000 THEN 6 WHEN total_order_value >= 100000 THEN 5
              WHEN total_order_value >= 10000 THEN 4 WHEN total_order_value >= 1000 THEN 3
              WHEN total_order_value >= 100 THEN 2 ELSE 1 END AS band_order,
         total_order_value, total_freight
  FROM fact_orders WHERE total_order_value IS NOT NULL),
g AS (SELECT band_order, count(*) AS orders, sum(total_order_value) AS v, coalesce(sum(total_freight), 0) AS f
      FROM b GROUP BY 1)
SELECT CASE band_order WHEN 1 THEN '<100' WHEN 2 THEN '100-1K' WHEN 3 THEN '1K-10K' WHEN 4 THEN '10K-100K'
                       WHEN 5 THEN '100K-1M' ELSE '1M+' END AS value_band,
       band_order, orders, CAST(v AS DOUBLE) AS total_order_value, CAST(f AS DOUBLE) AS total_freight,
       CASE WHEN v <> 0 THEN CAST(f AS DOUBLE) / CAST(v AS DOUBLE) * 100.0 END AS freight_pct
FROM g""")
ORACLE["executive_summary"] = qk(DELIVERY + f"""
, extra AS (
  SELECT count(CASE WHEN delivered THEN 1 END) AS dn, count(CASE WHEN late THEN 1 END) AS ln FROM d),
fr AS (SELECT coalesce(sum(total_freight), 0) AS total_freight FROM fact_orders),
ra AS (SELECT {mean('score')} AS average_rating FROM scored_reviews)
SELECT revenue, orders, customers, item_records, distinct_item_seq, average_order_value,
       CAST(total_freight AS DOUBLE) AS total_freight, average_rating,
       CASE WHEN dn > 0 THEN CAST(ln AS DOUBLE) / dn END AS late_rate
FROM kpis, extra, fr, ra""")

ORACLE["table_counts"] = q("""
SELECT 'fact_orders' AS table_name, count(*) AS row_count FROM fact_orders
UNION ALL SELECT 'fact_order_items', count(*) FROM fact_order_items
UNION ALL SELECT 'dim_customers', count(*) FROM dim_customers
UNION ALL SELECT 'dim_products', count(*) FROM dim_products
UNION ALL SELECT 'dim_sellers', count(*) FROM dim_sellers
UNION ALL SELECT 'fact_payments', count(*) FROM fact_payments
UNION ALL SELECT 'fact_reviews', count(*) FROM fact_reviews
UNION ALL SELECT 'sales_by_product', count(*) FROM sales_by_product
UNION ALL SELECT 'sales_by_seller', count(*) FROM sales_by_seller
UNION ALL SELECT 'sales_by_category', count(*) FROM sales_by_category""")
_FACT_ORDER_COLS = [
    "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
    "total_order_value", "total_freight", "item_count",
]
ORACLE["null_profile"] = q(
    ", n AS (SELECT count(*) AS row_count, "
    + ", ".join(f"count(CASE WHEN {c} IS NULL THEN 1 END) AS n_{c}" for c in _FACT_ORDER_COLS)
    + " FROM fact_orders)\n"
    + "\nUNION ALL\n".join(f"SELECT '{c}' AS column_name, n_{c} AS null_count, row_count FROM n" for c in _FACT_ORDER_COLS)
)
ORACLE["key_uniqueness"] = q("""
SELECT order_id, order_item_id, count(*) AS copies FROM fact_order_items GROUP BY 1, 2 HAVING count(*) > 1""")
ORPHAN_CHECKS = [
    ("order_items.order_id -> orders", "fact_order_items", "order_id", "fact_orders", "order_id"),
    ("order_items.product_id -> products", "fact_order_items", "product_id", "dim_products", "product_id"),
    ("order_items.seller_id -> sellers", "fact_order_items", "seller_id", "dim_sellers", "seller_id"),
    ("orders.customer_id -> customers", "fact_orders", "customer_id", "dim_customers", "customer_id"),
    ("payments.order_id -> orders", "fact_payments", "order_id", "fact_orders", "order_id"),
    ("reviews.order_id -> orders with items", "fact_reviews", "order_id", "fact_orders_inner", "order_id"),
]
ORACLE["orphan_keys"] = q("\nUNION ALL\n".join(
    f"SELECT '{name}' AS relation, CAST(count(*) AS BIGINT) AS orphan_rows, count(DISTINCT c.{ck}) AS orphan_keys "
    f"FROM {child} c WHERE c.{ck} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{ck})"
    for name, child, ck, parent, pk in ORPHAN_CHECKS
))
ORACLE["schema_enforcement"] = q("""
, v AS (SELECT
    count(CASE WHEN length(CAST(order_id AS VARCHAR)) > 50 THEN 1 END) AS v0,
    count(CASE WHEN order_id IS NULL THEN 1 END) AS v1,
    count(order_id) - count(DISTINCT order_id) AS v2,
    count(CASE WHEN length(CAST(customer_id AS VARCHAR)) > 50 THEN 1 END) AS v3,
    count(CASE WHEN length(CAST(order_status AS VARCHAR)) > 20 THEN 1 END) AS v4,
    count(CASE WHEN order_purchase_timestamp IS NOT NULL AND TRY_CAST(order_purchase_timestamp AS TIMESTAMP) IS NULL THEN 1 END) AS v5,
    count(CASE WHEN total_order_value IS NOT NULL AND TRY_CAST(total_order_value AS DECIMAL(10,2)) IS NULL THEN 1 END) AS v6,
    count(CASE WHEN total_freight IS NOT NULL AND TRY_CAST(total_freight AS DECIMAL(10,2)) IS NULL THEN 1 END) AS v7,
    count(CASE WHEN item_count IS NOT NULL AND TRY_CAST(item_count AS INTEGER) IS NULL THEN 1 END) AS v8
  FROM fact_orders)
SELECT 'order_id' AS column_name, 'varchar(50)' AS rule, v0 AS violations FROM v
UNION ALL SELECT 'order_id', 'not_null', v1 FROM v
UNION ALL SELECT 'order_id', 'unique', v2 FROM v
UNION ALL SELECT 'customer_id', 'varchar(50)', v3 FROM v
UNION ALL SELECT 'order_status', 'varchar(20)', v4 FROM v
UNION ALL SELECT 'order_purchase_timestamp', 'timestamp', v5 FROM v
UNION ALL SELECT 'total_order_value', 'numeric(10,2)', v6 FROM v
UNION ALL SELECT 'total_freight', 'numeric(10,2)', v7 FROM v
UNION ALL SELECT 'item_count', 'int', v8 FROM v""")
ORACLE["domain_check"] = q("""
SELECT 'review_score' AS column_name, CAST(review_score AS VARCHAR) AS value, count(*) AS rows
FROM fact_reviews WHERE review_score IS NOT NULL AND review_score NOT IN ('1', '2', '3', '4', '5') GROUP BY 2""")
ORACLE["domain_check_status"] = """
SELECT 'order_status' AS column_name, o_orderstatus AS value, count(*) AS rows
FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 2"""
ORACLE["domain_check_payment_type"] = """
SELECT 'payment_type' AS column_name, o_orderpriority AS value, count(*) AS rows
FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') GROUP BY 2"""

ORACLE["silver_geolocation"] = q("SELECT DISTINCT zip, city, state FROM geolocation")
ORACLE["silver_customers"] = q(
    "SELECT DISTINCT customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state FROM customers")
ORACLE["silver_orders"] = q("""
SELECT DISTINCT order_id, customer_id, order_status,
  TRY_CAST(CAST(order_purchase_timestamp AS VARCHAR) AS TIMESTAMP) AS order_purchase_timestamp,
  TRY_CAST(CAST(order_approved_at AS VARCHAR) AS TIMESTAMP) AS order_approved_at,
  TRY_CAST(CAST(order_delivered_carrier_date AS VARCHAR) AS TIMESTAMP) AS order_delivered_carrier_date,
  TRY_CAST(CAST(order_delivered_customer_date AS VARCHAR) AS TIMESTAMP) AS order_delivered_customer_date,
  TRY_CAST(CAST(order_estimated_delivery_date AS VARCHAR) AS TIMESTAMP) AS order_estimated_delivery_date
FROM orders_src""")
ORACLE["silver_products"] = q("""
SELECT DISTINCT p_partkey AS product_id, lower(trim(nullif(p_type, 'PROMO'))) AS product_category_name FROM part""")
ORACLE["dedupe_by_key"] = q("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
        l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST,
        l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST, l_linestatus NULLS FIRST,
        l_shipdate NULLS FIRST) AS rn
      FROM lineitem) WHERE rn = 1""")
ORACLE["clean_columns"] = q("""
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
       CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value FROM order_items""")
ORACLE["to_number"] = q("SELECT review_id, TRY_CAST(review_score AS DOUBLE) AS review_score_number FROM fact_reviews")
ORACLE["to_datetime"] = q("""
SELECT event_id, TRY_CAST(CASE WHEN event_id % 13 = 0 THEN 'junk' ELSE CAST(ts AS VARCHAR) END AS TIMESTAMP) AS parsed_ts
FROM events""")
ORACLE["drop_null"] = q("""
SELECT order_id, CAST(total_order_value AS DOUBLE) AS total_order_value FROM fact_orders WHERE total_order_value IS NOT NULL""")
ORACLE["fill_unknown"] = q("SELECT customer_id, coalesce(customer_state, 'unknown') AS customer_state FROM dim_customers")
ORACLE["low_rating"] = q("SELECT review_id, order_id, score AS review_score FROM scored_reviews WHERE score <= 2")
ORACLE["format_money"] = q(f"""
SELECT order_id, CAST(total_order_value AS DOUBLE) AS total_order_value, {money_text('total_order_value')} AS value_text
FROM fact_orders""")
ORACLE["format_count"] = q(f"""
SELECT order_id, CAST(total_order_value AS DOUBLE) AS total_order_value,
       {count_text('total_order_value')} AS value_count_text
FROM fact_orders""")
ORACLE["average_product_price"] = q(f"""
SELECT count(price) AS priced_items, {half_up_avg('price')} AS average_price FROM fact_order_items""")
ORACLE["review_by_location"] = q(PER_CUSTOMER + """
, per_order AS (SELECT order_id, sum(score) AS s, count(score) AS n FROM scored_reviews WHERE score IS NOT NULL GROUP BY 1),
oc AS (SELECT DISTINCT order_id, customer_id FROM fact_orders)
SELECT c.customer_state, CAST(sum(p.n) AS BIGINT) AS reviews, CAST(sum(p.s) AS DOUBLE) / sum(p.n) AS average_rating
FROM per_order p JOIN oc ON p.order_id = oc.order_id JOIN customer_one c ON oc.customer_id = c.customer_id
WHERE c.customer_state IS NOT NULL GROUP BY 1""")
ORACLE["silver_translation"] = q("""
SELECT DISTINCT lower(trim(p_type)) AS product_category_name, lower(p_type) || '_en' AS product_category_name_english
FROM part""")
ORACLE["freight_value_correlation"] = q("""
SELECT orders, CASE WHEN vx > 0 AND vy > 0 THEN round(CAST(cxy AS DOUBLE) / (sqrt(CAST(vx AS DOUBLE)) * sqrt(CAST(vy AS DOUBLE))), 9) END AS correlation
FROM (SELECT count(*) AS orders,
        CAST(count(*) AS HUGEINT) * sum(x * y) - sum(x) * sum(y) AS cxy,
        CAST(count(*) AS HUGEINT) * sum(x * x) - sum(x) * sum(x) AS vx,
        CAST(count(*) AS HUGEINT) * sum(y * y) - sum(y) * sum(y) AS vy
      FROM (SELECT CAST(total_order_value * 100 AS HUGEINT) AS x, CAST(total_freight * 100 AS HUGEINT) AS y
            FROM fact_orders WHERE total_order_value IS NOT NULL AND total_freight IS NOT NULL))""")


#: The same dirt as ``mercato.sources.dirty``, over the clean views.
DIRT = {
    "orders_src": """
  SELECT CASE WHEN order_id % 31 <> 11 THEN order_id END AS order_id,
         CASE WHEN order_id % 13 = 1 THEN NULL WHEN order_id % 17 = 2 THEN -customer_id ELSE customer_id END AS customer_id,
         CASE WHEN order_id % 19 <> 3 THEN order_status END AS order_status,
         CASE WHEN month(order_purchase_timestamp) NOT IN (3, 4, 9) AND order_id % 23 <> 5
              THEN order_purchase_timestamp END AS order_purchase_timestamp,
         order_approved_at, order_delivered_carrier_date,
         CASE WHEN order_id % 29 <> 7 THEN order_delivered_customer_date END AS order_delivered_customer_date,
         order_estimated_delivery_date
  FROM orders_src_clean""",
    "order_items": """
  SELECT CASE WHEN j % 37 = 1 THEN NULL WHEN j % 41 = 2 THEN -order_id ELSE order_id END AS order_id, order_item_id,
         CASE WHEN j % 43 = 3 THEN NULL WHEN j % 47 = 4 THEN -product_id ELSE product_id END AS product_id,
         CASE WHEN j % 53 <> 5 THEN seller_id END AS seller_id, shipping_limit_date,
         CASE WHEN j % 11 <> 6 AND product_id % 50 <> 0 THEN price END AS price,
         CASE WHEN j % 13 <> 7 THEN freight_value END AS freight_value
  FROM (SELECT *, order_id * 7 + order_item_id AS j FROM order_items_clean)""",
    "customers": """
  SELECT CASE WHEN customer_id % 21 <> 4 THEN customer_id END AS customer_id, customer_unique_id,
         customer_zip_code_prefix, customer_city, customer_state FROM customers_clean
  UNION ALL
  SELECT customer_id, customer_unique_id, customer_zip_code_prefix, 'Second City',
         CASE WHEN customer_id % 20 <> 3 THEN customer_state END FROM customers_clean WHERE customer_id % 10 = 3""",
    "sellers": """
  SELECT seller_id, seller_zip_code_prefix, CASE WHEN seller_id % 7 <> 2 THEN seller_city END AS seller_city,
         CASE WHEN seller_id % 11 <> 3 THEN seller_state END AS seller_state FROM sellers_clean
  UNION ALL
  SELECT seller_id, seller_zip_code_prefix, 'second town', seller_state FROM sellers_clean WHERE seller_id % 9 = 4""",
    "products": """
  SELECT CASE WHEN product_id % 71 <> 2 THEN product_id END AS product_id,
         CASE WHEN product_id % 15 <> 1 THEN product_category_name END AS product_category_name FROM products_clean""",
    "payments": """
  SELECT CASE WHEN order_id % 29 <> 3 THEN order_id END AS order_id, payment_sequential,
         CASE WHEN order_id % 17 <> 4 THEN payment_type END AS payment_type,
         CASE WHEN order_id % 19 <> 6 THEN payment_installments END AS payment_installments,
         CASE WHEN order_id % 13 <> 5 THEN payment_value END AS payment_value FROM payments_clean
  UNION ALL
  SELECT order_id, 2, payment_type, payment_installments, payment_value FROM payments_clean WHERE order_id % 5 = 0""",
    "reviews": """
  SELECT review_id,
         CASE WHEN review_id % 31 = 3 THEN NULL WHEN review_id % 37 = 4 THEN -order_id ELSE order_id END AS order_id,
         CASE WHEN review_id % 41 = 5 THEN NULL WHEN review_id % 43 = 6 THEN '' ELSE review_score END AS review_score,
         review_comment_title, review_comment_message,
         CASE WHEN review_id % 47 <> 8 THEN review_creation_date
              + to_months(CASE review_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 7 END) END AS review_creation_date,
         review_answer_timestamp
  FROM reviews_clean""",
}


def over_dirt(sql: str) -> str:
    """The statement with the dirty views in place of the clean ones."""
    views = ADAPTERS
    for name in DIRT:
        views = views.replace(f"\n{name} AS (", f"\n{name}_clean AS (")
    views += "".join(f",\n{name} AS ({body})" for name, body in DIRT.items())
    return sql.replace(ADAPTERS.strip(), views.strip())


DIRTY_ORACLE = {f"dirty_{name}": over_dirt(sql) for name, sql in ORACLE.items()}
