"""SQL text of the raw and cleaned tables, from which the check queries are put together."""

from __future__ import annotations

import re


def msum(x: str, where: str = "") -> str:
    """Exact sum of an amount."""
    return f"CAST(SUM(CAST({x} AS DECIMAL(28,6))){where} AS DOUBLE)"


def mavg(x: str) -> str:
    return f"{msum(x)} / COUNT({x})"


def msum_if(cond: str, x: str) -> str:
    return f"COALESCE({msum(x, f' FILTER (WHERE {cond})')}, 0.0)"


def ravg(x: str) -> str:
    return f"CAST(SUM(CAST(floor({x} * 1000000000 + 0.5) AS DECIMAL(20,0))) AS DOUBLE) / 1000000000 / COUNT({x})"


def n_if(cond: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {cond}) AS BIGINT)"


def pct_if(cond: str) -> str:
    return f"CAST(COUNT(*) FILTER (WHERE {cond}) AS DOUBLE) * 100 / COUNT(*)"


def padded(key: str, prefix: str, width: int) -> str:
    digits = f"CAST({key} AS VARCHAR)"
    return (
        f"'{prefix}' || CASE WHEN {key} < {10**width} THEN lpad({digits}, {width}, '0') ELSE {digits} END"
    )


SPEND_TIER = """CASE WHEN {v} > 5000 THEN 'VIP' WHEN {v} > 2000 THEN 'High Value'
  WHEN {v} > 500 THEN 'Medium Value' ELSE 'Low Value' END"""
CHURN = """CAST(CASE WHEN {d} > 180 THEN 0.8 WHEN {d} > 90 THEN 0.5 WHEN {d} > 30 THEN 0.2 ELSE 0.1 END AS DOUBLE)"""

# Name -> query. A query may use the names above it.
CTES: dict[str, str] = {
    "b_products": f"""
SELECT {padded('p_partkey', 'PROD-', 5)} AS product_id, p_name AS product_name, p_type AS category,
  CAST(p_size * 20 AS DOUBLE) AS price, CAST(p_partkey % 501 AS INT) AS stock_quantity,
  TIMESTAMP '1995-01-01 00:00:00' AS ingested_at
FROM part""",
    "b_customers": f"""
SELECT {padded('c_custkey', 'CUST-', 6)} AS customer_id,
  CASE WHEN c_custkey % 50 <> 0 THEN ' ' || c_name || '@Example.COM ' END AS email,
  ' Cust' AS first_name, 'N' || CAST(c_custkey AS VARCHAR) || ' ' AS last_name,
  'City' || CAST(c_custkey % 40 AS VARCHAR) AS city,
  CASE WHEN c_custkey % 29 <> 0 THEN n_name END AS state,
  DATE '1995-01-01' AS registration_date,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Premium' WHEN 'MACHINERY' THEN 'Standard' ELSE 'Basic' END AS customer_segment,
  TIMESTAMP '1995-01-01 00:00:00' AS ingested_at
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "b_orders": f"""
SELECT {padded('o_orderkey', 'ORD-', 8)} AS order_id,
  CASE WHEN o_orderkey % 62 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN {padded('o_orderkey', 'GUEST-', 8)}
       ELSE {padded('o_custkey', 'CUST-', 6)} END AS customer_id,
  CAST(o_orderdate AS DATE) AS order_date,
  {padded('lead_part', 'PROD-', 5)} AS product_id,
  CAST(CASE WHEN o_orderkey % 97 = 0 THEN 0 ELSE 1 + o_orderkey % 5 END AS INT) AS quantity,
  CASE o_orderstatus WHEN 'F' THEN ' completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Credit Card' WHEN '2-HIGH' THEN 'PayPal' ELSE 'Debit Card' END AS payment_method,
  CASE WHEN o_orderkey % 89 = 0 THEN CAST(-1 AS DOUBLE)
       ELSE CAST(floor(o_totalprice / 2.5) AS DOUBLE) / 100 END AS total_amount,
  o_orderdate AS ingested_at,
  CASE o_orderkey % 6 WHEN 0 THEN 'Web' WHEN 1 THEN ' mobile ' WHEN 2 THEN 'POS' WHEN 3 THEN 'In-Store'
       WHEN 4 THEN 'Phone' END AS order_source
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS lead_part FROM lineitem GROUP BY l_orderkey) lead_line
  ON o_orderkey = l_orderkey""",
    "live": """
SELECT * FROM b_orders WHERE upper(trim(status)) <> 'CANCELLED' AND order_id IS NOT NULL""",
    "history": """
SELECT customer_id, min(order_date) AS first_day, count(order_id) AS n_orders FROM live GROUP BY customer_id""",
    "silver": """
SELECT l.order_id, l.customer_id, l.product_id, l.order_date,
  CAST(year(l.order_date) AS INT) AS order_year, CAST(month(l.order_date) AS INT) AS order_month,
  CAST(quarter(l.order_date) AS INT) AS order_quarter, CAST(dayofweek(l.order_date) + 1 AS INT) AS day_of_week,
  dayofweek(l.order_date) IN (0, 6) AS is_weekend,
  l.quantity, upper(trim(l.status)) AS status, trim(l.payment_method) AS payment_method,
  trim(l.order_source) AS order_source,
  CASE WHEN lower(trim(l.order_source)) IN ('web', 'mobile', 'app') THEN 'Online'
       WHEN lower(trim(l.order_source)) IN ('store', 'pos') THEN 'In-Store' ELSE 'Partner' END AS channel_category,
  p.price AS unit_price, l.quantity * p.price AS subtotal,
  greatest(l.quantity * p.price - l.total_amount, CAST(0 AS DOUBLE)) AS discount_amount,
  l.total_amount * CAST(0.08 AS DOUBLE) AS tax_amount,
  CAST(CASE WHEN l.total_amount < 50 THEN 10 WHEN l.total_amount < 100 THEN 5 ELSE 0 END AS DOUBLE) AS shipping_cost,
  l.total_amount,
  (l.total_amount - l.quantity * p.price * CAST(0.6 AS DOUBLE)) / l.total_amount * 100 AS profit_margin_pct,
  trim(c.first_name) || ' ' || trim(c.last_name) AS customer_name, lower(trim(c.email)) AS customer_email,
  c.customer_segment, c.city AS customer_city, c.state AS customer_state,
  CAST(coalesce(h.n_orders, 1) AS BIGINT) AS customer_lifetime_orders,
  p.product_name, p.category AS product_category,
  CASE WHEN l.total_amount > 1000 THEN 'High Value' WHEN l.total_amount > 500 THEN 'Medium Value'
       WHEN l.total_amount > 100 THEN 'Low Value' ELSE 'Minimal Value' END AS order_value_tier,
  CASE WHEN coalesce(h.n_orders, 1) >= 10 THEN 'VIP' WHEN coalesce(h.n_orders, 1) >= 5 THEN 'Loyal'
       WHEN coalesce(h.n_orders, 1) >= 2 THEN 'Regular' ELSE 'New' END AS customer_value_tier,
  coalesce(l.order_date = h.first_day, FALSE) AS is_first_order,
  coalesce(h.n_orders, 1) > 1 AS is_repeat_customer,
  CASE WHEN l.total_amount <= 0 THEN 'INVALID_AMOUNT' WHEN l.quantity <= 0 THEN 'INVALID_QUANTITY'
       WHEN p.product_id IS NULL THEN 'MISSING_PRODUCT' WHEN c.customer_id IS NULL THEN 'MISSING_CUSTOMER'
       ELSE 'VALID' END AS data_quality_flag,
  TIMESTAMP '2001-08-02 00:00:00' AS processed_at
FROM live l
LEFT JOIN b_customers c ON l.customer_id = c.customer_id
LEFT JOIN b_products p ON l.product_id = p.product_id
LEFT JOIN history h ON l.customer_id = h.customer_id
WHERE l.total_amount > 0""",
    "valid": "SELECT * FROM silver WHERE data_quality_flag = 'VALID'",
    "profiles": f"""
SELECT c.customer_id, trim(c.first_name) || ' ' || trim(c.last_name) AS customer_name,
  lower(trim(c.email)) AS customer_email, c.customer_segment, c.city AS customer_city, c.state AS customer_state,
  c.registration_date, t.first_order_date, t.last_order_date, CAST(coalesce(t.n, 0) AS BIGINT) AS total_orders,
  t.spent AS lifetime_value, t.mean AS avg_order_value, {SPEND_TIER.format(v='t.spent')} AS customer_tier,
  {CHURN.format(d="date_diff('day', t.last_order_date, DATE '2001-08-02')")} AS churn_risk_score,
  TRUE AS is_active, TIMESTAMP '2001-08-02 00:00:00' AS updated_at
FROM b_customers c LEFT JOIN (
  SELECT customer_id, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
    count(DISTINCT order_id) AS n, {msum('total_amount')} AS spent, {mavg('total_amount')} AS mean
  FROM b_orders WHERE upper(trim(status)) <> 'CANCELLED' AND total_amount > 0 GROUP BY customer_id) t
  ON c.customer_id = t.customer_id
WHERE c.email IS NOT NULL""",
    "daily": f"""
SELECT order_date AS sale_date, CAST(year(order_date) AS INT) AS sale_year, CAST(month(order_date) AS INT) AS sale_month,
  CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_items_sold,
  CAST(count(DISTINCT customer_id) AS BIGINT) AS unique_customers,
  {n_if('is_first_order')} AS new_customers, {n_if('is_repeat_customer')} AS repeat_customers,
  {msum('total_amount')} AS total_revenue, {mavg('total_amount')} AS avg_order_value,
  max(total_amount) AS max_order_value, {pct_if("status = 'COMPLETED'")} AS completion_rate,
  {ravg('profit_margin_pct')} AS avg_profit_margin, {msum('discount_amount')} AS total_discounts,
  {pct_if('is_weekend')} AS weekend_order_pct,
  {msum_if("channel_category = 'Online'", 'total_amount')} AS online_revenue,
  {msum_if("channel_category = 'In-Store'", 'total_amount')} AS instore_revenue,
  {msum_if("channel_category = 'Partner'", 'total_amount')} AS partner_revenue,
  {n_if("payment_method = 'Credit Card'")} AS credit_card_orders, {n_if("payment_method = 'PayPal'")} AS paypal_orders,
  {n_if("payment_method NOT IN ('Credit Card', 'PayPal')")} AS other_payment_orders,
  {msum_if("customer_segment = 'Premium'", 'total_amount')} AS premium_revenue,
  {msum_if("customer_segment = 'Standard'", 'total_amount')} AS standard_revenue,
  {msum_if("customer_segment = 'Basic'", 'total_amount')} AS basic_revenue,
  TIMESTAMP '2001-08-02 00:00:00' AS calculated_at
FROM valid GROUP BY order_date""",
    "spend": f"""
SELECT customer_id, customer_name, customer_email, customer_segment, customer_city, customer_state,
  CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders, {msum('total_amount')} AS lifetime_value,
  {mavg('total_amount')} AS avg_order_value, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
  CAST(date_diff('day', max(order_date), DATE '2001-08-02') AS INT) AS days_since_last_order
FROM valid GROUP BY ALL""",
    "c360": f"""
SELECT s.customer_id, s.customer_name, s.customer_email, s.customer_segment,
  {SPEND_TIER.format(v='s.lifetime_value')} AS customer_tier, s.customer_city, s.customer_state,
  c.registration_date, s.first_order_date, s.last_order_date, s.days_since_last_order, s.total_orders,
  s.lifetime_value, s.avg_order_value, fc.v AS favorite_category, fp.v AS favorite_payment_method,
  fs.v AS favorite_channel, r.recency_score, r.frequency_score, r.monetary_score,
  CAST(r.recency_score + r.frequency_score + r.monetary_score AS DOUBLE) / 3 AS rfm_score,
  {CHURN.format(d='s.days_since_last_order')} AS churn_risk_score, r.lifetime_value_rank, r.segment_rank,
  TIMESTAMP '2001-08-02 00:00:00' AS last_updated
FROM spend s
JOIN (SELECT customer_id,
    CAST(ntile(5) OVER (ORDER BY days_since_last_order, customer_id) AS INT) AS recency_score,
    CAST(ntile(5) OVER (ORDER BY total_orders DESC, customer_id) AS INT) AS frequency_score,
    CAST(ntile(5) OVER (ORDER BY lifetime_value DESC, customer_id) AS INT) AS monetary_score,
    CAST(rank() OVER (ORDER BY lifetime_value DESC) AS BIGINT) AS lifetime_value_rank,
    CAST(rank() OVER (PARTITION BY customer_segment ORDER BY lifetime_value DESC) AS BIGINT) AS segment_rank
  FROM spend) r ON s.customer_id = r.customer_id
LEFT JOIN (SELECT customer_id, product_category AS v FROM valid GROUP BY customer_id, product_category QUALIFY row_number() OVER
  (PARTITION BY customer_id ORDER BY count(*) DESC, product_category NULLS LAST) = 1) fc ON s.customer_id = fc.customer_id
LEFT JOIN (SELECT customer_id, payment_method AS v FROM valid GROUP BY customer_id, payment_method QUALIFY row_number() OVER
  (PARTITION BY customer_id ORDER BY count(*) DESC, payment_method NULLS LAST) = 1) fp ON s.customer_id = fp.customer_id
LEFT JOIN (SELECT customer_id, order_source AS v FROM valid GROUP BY customer_id, order_source QUALIFY row_number() OVER
  (PARTITION BY customer_id ORDER BY count(*) DESC, order_source NULLS LAST) = 1) fs ON s.customer_id = fs.customer_id
LEFT JOIN b_customers c ON s.customer_id = c.customer_id""",
    "moves": f"""
SELECT product_id, product_name, product_category, CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders,
  CAST(sum(quantity) AS BIGINT) AS units_sold, {msum('total_amount')} AS total_revenue,
  {mavg('unit_price')} AS avg_selling_price, CAST(count(DISTINCT customer_id) AS BIGINT) AS unique_customers,
  {msum_if("order_date >= DATE '2001-07-03'", 'total_amount')} AS revenue_last_30d,
  {msum_if("order_date BETWEEN DATE '2001-06-03' AND DATE '2001-07-02'", 'total_amount')} AS revenue_prev_30d,
  CAST(coalesce(sum(quantity) FILTER (WHERE order_date >= DATE '2001-07-03'), 0) AS BIGINT) AS units_last_30d
FROM valid GROUP BY product_id, product_name, product_category""",
    "p_mean": f"SELECT {mavg('revenue_last_30d')} AS mean_last FROM moves",
    "pperf": """
SELECT m.product_id, m.product_name, m.product_category, m.total_orders, m.units_sold, m.total_revenue,
  m.avg_selling_price, m.unique_customers, m.revenue_last_30d, m.revenue_prev_30d,
  CASE WHEN m.revenue_prev_30d <> 0
       THEN (m.revenue_last_30d - m.revenue_prev_30d) / m.revenue_prev_30d * 100 END AS revenue_growth_pct,
  CASE WHEN m.revenue_last_30d > mean_last
       THEN CASE WHEN m.revenue_last_30d > m.revenue_prev_30d * CAST(1.1 AS DOUBLE) THEN 'Star' ELSE 'Cash Cow' END
       WHEN m.revenue_last_30d > m.revenue_prev_30d * CAST(1.1 AS DOUBLE) THEN 'Question Mark'
       ELSE 'Dog' END AS performance_quadrant,
  CAST(rank() OVER (ORDER BY m.total_revenue DESC) AS BIGINT) AS revenue_rank,
  CAST(rank() OVER (PARTITION BY m.product_category ORDER BY m.total_revenue DESC) AS BIGINT) AS category_rank,
  s.stock_quantity AS current_stock,
  CASE WHEN m.units_last_30d <> 0
       THEN CAST(trunc(s.stock_quantity / (m.units_last_30d / CAST(30 AS DOUBLE))) AS BIGINT) END AS days_of_stock_left,
  m.units_last_30d > 0 AND s.stock_quantity < m.units_last_30d / CAST(30 AS DOUBLE) * 7 AS reorder_recommended,
  TIMESTAMP '2001-08-02 00:00:00' AS last_calculated
FROM moves m CROSS JOIN p_mean LEFT JOIN b_products s ON m.product_id = s.product_id""",
    "job_orders": """
SELECT o.order_id, o.customer_id, o.order_date, o.product_id, o.quantity, o.status, o.total_amount,
  c.customer_segment, c.state, p.category, p.price AS unit_price,
  CAST(year(o.order_date) AS INT) AS order_year, CAST(month(o.order_date) AS INT) AS order_month,
  o.quantity * p.price AS calculated_revenue,
  CASE WHEN o.total_amount > 500 THEN 'High' ELSE 'Normal' END AS order_value_tier,
  TIMESTAMP '2001-08-02 00:00:00' AS processed_at
FROM b_orders o LEFT JOIN b_customers c USING (customer_id) LEFT JOIN b_products p USING (product_id)
WHERE o.status <> 'cancelled'""",
    "dag_orders": """
SELECT o.order_id, o.customer_id, o.order_date, o.product_id, o.quantity, o.status, o.payment_method,
  o.total_amount, o.ingested_at, o.order_source,
  CAST(year(o.order_date) AS INT) AS order_year, CAST(month(o.order_date) AS INT) AS order_month,
  CAST(quarter(o.order_date) AS INT) AS order_quarter, c.customer_segment, c.state, p.category, p.price,
  p.price AS unit_price, o.quantity * p.price AS revenue, coalesce(o.total_amount > 500, FALSE) AS is_high_value
FROM b_orders o LEFT JOIN b_customers c USING (customer_id) LEFT JOIN b_products p USING (product_id)
WHERE o.status IS DISTINCT FROM 'cancelled'""",
    "dag_daily": f"""
SELECT order_date AS date, count(order_id) AS num_orders, coalesce({msum('total_amount')}, 0.0) AS total_revenue,
  count(DISTINCT customer_id) AS unique_customers, CAST(coalesce(sum(quantity), 0) AS BIGINT) AS total_items,
  coalesce({msum('total_amount')}, 0.0) / nullif(count(order_id), 0) AS avg_order_value
FROM dag_orders WHERE order_date IS NOT NULL GROUP BY order_date""",
    "dag_customers": f"""
SELECT customer_id, count(order_id) AS total_orders, coalesce({msum('total_amount')}, 0.0) AS lifetime_value,
  min(order_date) AS first_order, max(order_date) AS last_order,
  CAST(date_diff('day', min(order_date), max(order_date)) AS INT) AS days_active
FROM dag_orders WHERE customer_id IS NOT NULL GROUP BY customer_id""",
    "dag_regions": f"""
SELECT state, count(order_id) AS num_orders, coalesce({msum('total_amount')}, 0.0) AS total_revenue,
  count(DISTINCT customer_id) AS unique_customers
FROM dag_orders WHERE state IS NOT NULL GROUP BY state""",
}


def used(text: str, names: list[str]) -> set[str]:
    return {n for n in names if re.search(rf"\b(FROM|JOIN)\s+\(?\s*{n}\b", text)}


def sql(body: str, **extra: str) -> str:
    """``body`` with the named queries it needs put in front as a WITH clause.

    ``extra`` adds named queries of this check only, in order, after the shared ones.
    """
    parts = {**CTES, **extra}
    names = list(parts)
    needed = used(body, names)
    for name in reversed(names):
        if name in needed:
            needed |= used(parts[name], names) - {name}
    chosen = [f"{n} AS ({parts[n].strip()})" for n in names if n in needed]
    return ("WITH " + ",\n".join(chosen) + "\n" if chosen else "") + body.strip()
