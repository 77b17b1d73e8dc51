"""The SQL-expressible reports as DuckDB text over the raw tables."""

from __future__ import annotations

from loomcart.catalog import KNOWN_FEATURES, KNOWN_TREES, SIGNUP_SLICE, SLICE
from loomcart.functions.distributions import Z_POWER_80_PERCENT, Z_TWO_SIDED_5_PERCENT

# --- the star schema ---

_CUSTOMERS = """dim_customers AS (
  SELECT c_custkey AS customer_id,
         date_add(DATE '1995-01-01', CAST((c_custkey * 7919) % 1800 AS INT)) AS signup_date,
         n_name AS country,
         CASE WHEN c_custkey % 25 = 0 THEN 'Other' WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         CAST(18 + (c_custkey * 31) % 47 AS INT) AS age,
         c_mktsegment AS acquisition_channel,
         CASE WHEN (c_custkey * 7) % 10 < 4 THEN 'control' ELSE 'treatment' END AS ab_test_group
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey)"""

_PRODUCTS = """dim_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS sub_category,
         CAST(ROUND(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(0.60 AS DECIMAL(3,2)), 2) AS DECIMAL(10,2)) AS unit_cost,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price
  FROM part)"""

_ORDERS = """fact_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         CASE WHEN o_orderstatus IN ('F', 'O') THEN 'Completed'
              WHEN o_orderpriority < '3' THEN 'Cancelled' ELSE 'Returned' END AS order_status,
         CASE WHEN o_orderkey % 20 < 11 THEN 'Web' ELSE 'Mobile App' END AS channel,
         CASE WHEN (o_custkey * 7) % 10 < 4 THEN 'control' ELSE 'treatment' END AS ab_test_group,
         CAST(o_orderdate AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-03-31' AS in_ab_test,
         CASE WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'
                   AND (o_custkey * 7) % 10 >= 4
              THEN CAST(0.15 AS DECIMAL(5,2)) ELSE CAST(0.00 AS DECIMAL(5,2)) END AS discount_pct
  FROM orders)"""

_ITEMS = """fact_order_items AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id, l_partkey AS product_id,
         CAST(l_quantity AS INT) AS quantity,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
         CAST(ROUND(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(5,2))), 2)
              AS DECIMAL(15,2)) AS line_total
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey)"""

_DATES = """date_range AS (
  SELECT min(d) AS first_day, max(d) AS last_day
  FROM (SELECT signup_date AS d FROM dim_customers UNION ALL SELECT order_date FROM fact_orders)),
dim_date AS (
  SELECT d AS date, CAST(day(d) AS INT) AS day, CAST(month(d) AS INT) AS month, strftime(d, '%b') AS month_name,
         CAST(quarter(d) AS INT) AS quarter, CAST(year(d) AS INT) AS year, dayname(d) AS day_of_week,
         isodow(d) >= 6 AS is_weekend
  FROM (SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS d FROM date_range))"""

_STAR = ",\n".join([_CUSTOMERS, _PRODUCTS, _ORDERS, _ITEMS, _DATES])

# --- shared steps ---

_VALUES = """completed_values AS (
  SELECT o.order_id, o.customer_id, o.order_date, o.ab_test_group, o.in_ab_test, sum(i.line_total) AS order_value
  FROM fact_orders o JOIN fact_order_items i ON i.order_id = o.order_id
  WHERE o.order_status = 'Completed'
  GROUP BY ALL)"""



def _fifth(place: str) -> str:
    """Bucket of a place: the first ``extra`` buckets have ``size + 1`` rows, the others ``size``."""
    wide = "(size + 1)"
    return f"""CASE WHEN {place} <= extra * {wide} THEN ({place} - 1) // {wide} + 1
         ELSE extra + ({place} - 1 - extra * {wide}) // greatest(size, 1) + 1 END"""


_RFM = f"""{_VALUES},
rfm_raw AS (
  SELECT customer_id, max(order_date) AS last_order_date,
         CAST(datediff('day', max(order_date), (SELECT max(order_date) FROM completed_values)) AS INT) AS recency_days,
         count(DISTINCT order_id) AS frequency, round(sum(order_value), 2) AS monetary
  FROM completed_values GROUP BY customer_id),
places AS (
  SELECT *, row_number() OVER (ORDER BY recency_days, customer_id) AS rp, row_number() OVER (ORDER BY frequency, customer_id) AS fp,
         row_number() OVER (ORDER BY monetary, customer_id) AS mp, n // 5 AS size, n % 5 AS extra
  FROM rfm_raw, (SELECT count(*) AS n FROM rfm_raw)),
rfm_scores AS (
  SELECT customer_id, recency_days, frequency, monetary, CAST(6 - {_fifth("rp")} AS INT) AS r_score,
         CAST({_fifth("fp")} AS INT) AS f_score, CAST({_fifth("mp")} AS INT) AS m_score
  FROM places),
rfm_segments AS (
  SELECT *, CAST(r_score + f_score + m_score AS INT) AS rfm_total,
         CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
              WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers'
              WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customers'
              WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
              WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Lost'
              ELSE 'Needs Attention' END AS rfm_segment
  FROM rfm_scores)"""

_COHORT = """cohorts AS (
  SELECT customer_id, date_trunc('month', signup_date) AS cohort FROM dim_customers),
activity AS (
  SELECT c.cohort, c.customer_id,
         CAST(datediff('month', c.cohort, m.order_month) AS INT) AS month_index
  FROM cohorts c
  JOIN (SELECT DISTINCT customer_id, date_trunc('month', order_date) AS order_month
        FROM fact_orders WHERE order_status = 'Completed') m USING (customer_id)
  WHERE datediff('month', c.cohort, m.order_month) BETWEEN 0 AND 12)"""

_GROWTH = f"""{_VALUES},
monthly AS (
  SELECT strftime(order_date, '%Y-%m') AS month, CAST(round(sum(order_value), 2) AS DOUBLE) AS revenue
  FROM completed_values GROUP BY 1),
lagged AS (
  SELECT month, revenue, lag(revenue, 1) OVER (ORDER BY month) AS prev_month_revenue,
         lag(revenue, 12) OVER (ORDER BY month) AS revenue_12mo_ago
  FROM monthly),
growth AS (
  SELECT month, revenue, prev_month_revenue,
         round(100.0::DOUBLE * (revenue - prev_month_revenue) / nullif(prev_month_revenue, 0), 1) + 0.0 AS mom_growth_pct,
         revenue_12mo_ago,
         round(100.0::DOUBLE * (revenue - revenue_12mo_ago) / nullif(revenue_12mo_ago, 0), 1) + 0.0 AS yoy_growth_pct
  FROM lagged)"""

_GROSS_DAILY = """daily AS (
  SELECT o.order_date AS date, sum(i.quantity * i.unit_price) AS completed_revenue
  FROM fact_orders o JOIN fact_order_items i USING (order_id)
  WHERE o.order_status = 'Completed' GROUP BY 1)"""

_AB = """window_orders AS (
  SELECT o.order_id, o.customer_id, v.order_value
  FROM fact_orders o
  LEFT JOIN (SELECT order_id, sum(line_total) AS order_value FROM fact_order_items GROUP BY 1) v USING (order_id)
  WHERE o.in_ab_test AND o.order_status = 'Completed'),
per_customer AS (
  SELECT c.customer_id, c.ab_test_group, count(w.order_id) > 0 AS converted,
         coalesce(sum(w.order_value), 0) AS spent
  FROM dim_customers c LEFT JOIN window_orders w USING (customer_id)
  GROUP BY 1, 2),
by_customer AS (
  SELECT ab_test_group, count(*) AS n, count(*) FILTER (WHERE converted) AS converted,
         count(*) FILTER (WHERE converted) / count(*)::DOUBLE AS rate,
         CAST(sum(spent) AS DOUBLE) / count(*) AS m, var_samp(CAST(spent AS DOUBLE)) AS v
  FROM per_customer GROUP BY 1),
by_order AS (
  SELECT c.ab_test_group, count(w.order_value) AS n, CAST(sum(w.order_value) AS DOUBLE) / count(w.order_value) AS m,
         var_samp(CAST(w.order_value AS DOUBLE)) AS v
  FROM window_orders w JOIN dim_customers c USING (customer_id) GROUP BY 1)"""


def _welch(table: str) -> str:
    """Both groups side by side with t and the Welch-Satterthwaite df."""
    return f"""SELECT c.m AS cm, t.m AS tm, (t.m - c.m) / sqrt(c.v / c.n + t.v / t.n) AS t,
         power(c.v / c.n + t.v / t.n, 2)
           / (power(c.v / c.n, 2) / (c.n - 1) + power(t.v / t.n, 2) / (t.n - 1)) AS df
  FROM {table} c, {table} t WHERE c.ab_test_group = 'control' AND t.ab_test_group = 'treatment'"""


_ZTEST = """SELECT c.rate AS cr, t.rate AS tr, c.n AS cn,
         (t.rate - c.rate) / sqrt(p.p * (1 - p.p) * (1 / c.n::DOUBLE + 1 / t.n::DOUBLE)) AS z
  FROM by_customer c, by_customer t, (SELECT sum(converted) / sum(n)::DOUBLE AS p FROM by_customer) p
  WHERE c.ab_test_group = 'control' AND t.ab_test_group = 'treatment'"""


def _simpson(density: str) -> str:
    """1 - 2 * (integral of ``density`` in u over 0..x) by Simpson's rule with 4,000 intervals; x is the outer column."""
    return f"""(SELECT 1 - 2 * sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * {density}) * x / 12000
      FROM (SELECT i, x * i / 4000.0::DOUBLE AS u FROM range(4001) r(i)))"""


_SUMMARY = f"""{_AB},
tests AS (
  SELECT 'Conversion Rate' AS metric, cr AS control, tr AS treatment, abs(z) AS x, NULL::DOUBLE AS df FROM ({_ZTEST})
  UNION ALL
  SELECT 'Revenue per Customer', cm, tm, abs(t), df FROM ({_welch('by_customer')})
  UNION ALL
  SELECT 'Average Order Value', cm, tm, abs(t), df FROM ({_welch('by_order')})),
judged AS (
  SELECT *, CASE WHEN df IS NULL THEN {_simpson("exp(-u * u / 2) / sqrt(2 * pi())")}
       ELSE {_simpson("exp(lgamma((df + 1) / 2) - lgamma(df / 2) - ln(1 + u * u / df) * (df + 1) / 2) / sqrt(df * pi())")}
       END AS p
  FROM tests)"""

_ASSUMPTIONS = f"""{_AB},
assumptions AS (
  SELECT t.n AS reached, round(c.rate, 3) AS conversion, round(o.m, 0) AS order_value,
         0.004::DOUBLE AS lift_per_point, round(1 - m.cost / m.list, 2) AS margin
  FROM by_customer c, by_customer t, by_order o,
       (SELECT CAST(sum(i.quantity * p.unit_cost) AS DOUBLE) AS cost, CAST(sum(i.quantity * p.unit_price) AS DOUBLE) AS list
        FROM fact_order_items i JOIN dim_products p USING (product_id)) m
  WHERE c.ab_test_group = 'control' AND t.ab_test_group = 'treatment' AND o.ab_test_group = 'control')"""


def _scenario(discounts: str) -> str:
    return f"""{_ASSUMPTIONS},
steps AS (
  SELECT d AS discount, CAST(conversion AS DECIMAL(9,6)) + CAST(lift_per_point AS DECIMAL(9,6)) * d * 100 AS rate, reached,
         CAST(order_value AS DECIMAL(15,2)) AS order_value, CAST(margin AS DECIMAL(9,6)) AS margin
  FROM assumptions, (SELECT CAST({discounts} AS DECIMAL(5,2)) AS d)),
priced AS (
  SELECT *, CAST(round(reached * rate, 0) AS BIGINT) AS buyers, order_value * (1 - discount) AS price FROM steps),
scenario AS (
  SELECT CAST(discount AS DOUBLE) AS discount, CAST(round(rate, 6) AS DOUBLE) AS projected_conversion,
         buyers AS customers_converted, CAST(price AS DOUBLE) AS effective_order_value,
         CAST(round(buyers * price, 2) AS DOUBLE) AS projected_revenue,
         CAST(round(buyers * price * greatest(margin - discount, 0), 2) AS DOUBLE) AS projected_margin
  FROM priced)"""


_FEATURES = """totals AS (
  SELECT order_id, sum(line_total) AS order_value FROM fact_order_items GROUP BY 1),
numbered AS (
  SELECT o.*, v.order_value, datediff('day', c.signup_date, o.order_date) AS day_no
  FROM fact_orders o JOIN dim_customers c USING (customer_id) LEFT JOIN totals v USING (order_id)
  WHERE o.order_status = 'Completed')"""

_CLV = f"""{_FEATURES},
early AS (
  SELECT customer_id, count(order_id) AS orders_first90,
         CAST(coalesce(sum(order_value), 0) AS DOUBLE) AS spend_first90, count(order_value) AS valued
  FROM numbered WHERE day_no BETWEEN 0 AND 90 GROUP BY 1),
later AS (
  SELECT customer_id, CAST(coalesce(sum(order_value), 0) AS DOUBLE) AS spend_next90
  FROM numbered WHERE day_no BETWEEN 91 AND 180 GROUP BY 1),
clv AS (
  SELECT customer_id, orders_first90, spend_first90,
         coalesce(spend_first90 / nullif(valued, 0), 0) AS avg_order_value_first90,
         c.age, c.acquisition_channel, c.country, coalesce(l.spend_next90, 0) AS spend_next90
  FROM early JOIN dim_customers c USING (customer_id) LEFT JOIN later l USING (customer_id)
  WHERE c.signup_date <= (SELECT max(signup_date) - 181 FROM dim_customers))"""

_CHURN = f"""{_FEATURES},
early AS (
  SELECT customer_id, count(order_id) AS orders_0_180,
         CAST(coalesce(sum(order_value), 0) AS DOUBLE) AS spend_0_180, count(order_value) AS valued,
         avg(CASE WHEN channel = 'Web' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS channel_web_share
  FROM numbered WHERE day_no BETWEEN 0 AND 180 GROUP BY 1),
later AS (
  SELECT customer_id, count(*) AS orders_181_270 FROM numbered WHERE day_no BETWEEN 181 AND 270 GROUP BY 1),
churn AS (
  SELECT customer_id, c.age, c.acquisition_channel, c.country, e.orders_0_180, e.spend_0_180,
         coalesce(e.spend_0_180 / nullif(e.valued, 0), 0) AS avg_order_value, e.channel_web_share,
         coalesce(l.orders_181_270, 0) AS orders_181_270,
         CAST(coalesce(l.orders_181_270, 0) = 0 AS INT) AS churned
  FROM dim_customers c JOIN early e USING (customer_id) LEFT JOIN later l USING (customer_id)
  WHERE c.signup_date <= (SELECT max(signup_date) - 271 FROM dim_customers))"""

_HASH = "CAST('0x' || substr(md5(customer_id::VARCHAR || ':42'), 1, 8) AS BIGINT)"

_CHURN_SPLIT = f"""{_CHURN},
churn_split AS (
  SELECT customer_id, churned,
         row_number() OVER (PARTITION BY churned ORDER BY {_HASH}, customer_id)
           <= floor((count(*) OVER (PARTITION BY churned) * 20 + 50) / 100) AS is_test
  FROM churn)"""

_SCALED = """logged AS (
  SELECT *, CAST(recency_days AS DOUBLE) AS r, ln(1 + CAST(frequency AS DOUBLE)) AS f,
         ln(1 + CAST(monetary AS DOUBLE)) AS m FROM rfm_segments),
scaled AS (
  SELECT l.customer_id, l.rfm_segment, (l.r - s.mr) / s.sr AS recency_scaled, (l.f - s.mf) / s.sf AS frequency_scaled,
         (l.m - s.mm) / s.sm AS monetary_scaled
  FROM logged l, (SELECT avg(r) AS mr, stddev_pop(r) AS sr, avg(f) AS mf, stddev_pop(f) AS sf,
                         avg(m) AS mm, stddev_pop(m) AS sm FROM logged) s)"""

_CENTROIDS = """centroids AS (
  SELECT rfm_segment AS id, round(avg(recency_scaled), 6) AS r, round(avg(frequency_scaled), 6) AS f,
         round(avg(monetary_scaled), 6) AS m FROM scaled GROUP BY 1)"""

_LABELS = """profile AS (
  SELECT CAST(r_score - 1 AS INT) AS cluster, CAST(round_even(CAST(avg_r AS DECIMAL(30,8)), 1) AS DOUBLE) AS recency_days,
         CAST(round_even(CAST(avg_f AS DECIMAL(30,8)), 1) AS DOUBLE) AS frequency,
         CAST(round_even(CAST(avg_m AS DECIMAL(30,8)), 1) AS DOUBLE) AS monetary, customers
  FROM (SELECT r_score, sum(recency_days) / count(*)::DOUBLE AS avg_r, sum(frequency) / count(*)::DOUBLE AS avg_f,
               CAST(sum(monetary) AS DOUBLE) / count(*) AS avg_m, count(*) AS customers FROM rfm_segments GROUP BY 1)),
labels AS (
  SELECT cluster, ['VIP / Champions', 'Loyal Regulars', 'Promising', 'At Risk', 'Dormant / Lost'][
           row_number() OVER (ORDER BY monetary DESC, cluster)] AS segment_label FROM profile),
labelled AS (SELECT s.*, l.segment_label FROM rfm_segments s JOIN labels l ON l.cluster = s.r_score - 1)"""

_KNOWN = """known AS (SELECT c.*, s.is_test, 1 / (1 + orders_0_180 / 2.0::DOUBLE) AS p
  FROM churn c JOIN churn_split s USING (customer_id)),
tested AS (SELECT churned, p, CAST(p > 0.5 AS INT) AS guess FROM known WHERE is_test),
classes AS (SELECT k AS churned, count(*) FILTER (churned = k) AS support, count(*) FILTER (guess = k) AS called,
         count(*) FILTER (guess = k AND churned = k) AS hit FROM tested, (VALUES (0), (1)) v(k) GROUP BY k),
scores AS (SELECT churned, support, coalesce(hit / nullif(called, 0)::DOUBLE, 0) AS precision,
         coalesce(hit / nullif(support, 0)::DOUBLE, 0) AS recall FROM classes),
report AS (SELECT churned, round(precision, 6) AS precision, round(recall, 6) AS recall,
         round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 6) AS f1, support FROM scores)"""

_RFM_COLUMNS = "customer_id, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary"


_SIGNED_UP = f"signup_date BETWEEN DATE '{SIGNUP_SLICE['signup_from']}' AND DATE '{SIGNUP_SLICE['signup_to']}'"


def _in(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _kpis(customers: str, orders: str, items: str) -> str:
    return f"""SELECT CAST(r.total AS DOUBLE) AS total_revenue, CAST(coalesce(r.done, 0) AS DOUBLE) AS completed_revenue,
         o.n AS total_orders, round(CAST(coalesce(r.done, 0) AS DOUBLE) / nullif(o.n, 0), 4) AS average_order_value,
         c.n AS total_customers
  FROM (SELECT sum(i.quantity * i.unit_price) AS total,
               sum(i.quantity * i.unit_price) FILTER (WHERE o.order_status = 'Completed') AS done
        FROM {items} i LEFT JOIN {orders} o USING (order_id)) r,
       (SELECT count(DISTINCT order_id) AS n FROM {orders}) o,
       (SELECT count(DISTINCT customer_id) AS n FROM {customers}) c"""


def _pk(table: str, key: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{key}' AS key_column, count(*) AS total_rows,
         count(DISTINCT {key}) AS distinct_keys, count({key}) - count(DISTINCT {key}) AS duplicate_rows,
         count(*) - count({key}) AS null_keys FROM {table}"""


def _fk(fact: str, column: str, dim: str, key: str) -> str:
    orphan = f"{column} NOT IN (SELECT {key} FROM {dim} WHERE {key} IS NOT NULL)"
    return f"""SELECT '{fact}.{column}' AS reference, '{dim}.{key}' AS target, count({column}) AS referencing_rows,
         count(*) FILTER (WHERE {orphan}) AS orphan_rows, count(DISTINCT {column}) FILTER (WHERE {orphan}) AS orphan_keys
  FROM {fact}"""


_KEYS = [
    ("dim_customers", "customer_id"),
    ("dim_products", "product_id"),
    ("dim_date", "date"),
    ("fact_orders", "order_id"),
    ("fact_order_items", "order_item_id"),
]
_REFERENCES = [
    ("fact_orders", "customer_id", "dim_customers", "customer_id"),
    ("fact_orders", "order_date", "dim_date", "date"),
    ("fact_order_items", "order_id", "fact_orders", "order_id"),
    ("fact_order_items", "product_id", "dim_products", "product_id"),
]


def _value(v: object) -> str:
    return "NULL" if v is None else f"{v}::DOUBLE[]" if isinstance(v, list) else f"{v!r}::DOUBLE" if isinstance(v, float) else str(v)


# Every row walks down every tree of the known model.
_NODES = f"""nodes(tree, node, feature, threshold, categories, l, r, value, met, gain) AS (
  VALUES {", ".join("(" + ", ".join(map(_value, n)) + ")" for n in KNOWN_TREES)})"""

_WALK = f"""{_NODES},
walk AS (
  SELECT customer_id, [{", ".join(f"CAST({c} AS DOUBLE)" for c in KNOWN_FEATURES)}] AS x, tree, 0 AS node
  FROM churn, (SELECT DISTINCT tree FROM nodes)
  UNION ALL
  SELECT w.customer_id, w.x, w.tree, CASE WHEN w.x[n.feature + 1] <= n.threshold OR list_contains(n.categories, w.x[n.feature + 1])
                                          THEN n.l ELSE n.r END
  FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE n.feature >= 0),
margins AS (
  SELECT customer_id, sum(value) AS margin FROM walk JOIN nodes USING (tree, node) WHERE feature < 0 GROUP BY 1)"""


def _query(body: str, *steps: str) -> str:
    return "WITH " + ",\n".join([_STAR, *steps]) + "\n" + body


def oracle_sql() -> dict[str, str]:
    welch = "SELECT round(cm, 4) AS control_mean, round(tm, 4) AS treatment_mean, round(t, 6) AS t_stat, round(df, 4) AS degrees_of_freedom, (SELECT round(p, 6) FROM judged WHERE metric = '{}') AS p_value FROM ({})"
    z_sum = Z_TWO_SIDED_5_PERCENT + Z_POWER_80_PERCENT
    sliced = f"""sliced_customers AS (
  SELECT * FROM dim_customers WHERE country IN ({_in(SLICE["countries"])}) AND acquisition_channel IN ({_in(SLICE["channels"])})),
sliced_orders AS (
  SELECT o.* FROM fact_orders o SEMI JOIN sliced_customers USING (customer_id)
  WHERE order_date BETWEEN DATE '{SLICE["first_day"]}' AND DATE '{SLICE["last_day"]}'),
sliced_items AS (SELECT i.* FROM fact_order_items i SEMI JOIN sliced_orders USING (order_id))"""
    heat = ", ".join(f"count(*) FILTER (WHERE month_index = {i}) AS m{i}" for i in range(13))
    return {
        "load_report": _query(
            " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS loaded_rows FROM {t}" for t, _ in _KEYS)
        ),
        "csv_roundtrip": _query(
            """SELECT order_status, channel, in_ab_test, count(order_id) AS orders, min(order_date) AS first_day,
         max(order_date) AS last_day, CAST(sum(discount_pct) AS DOUBLE) AS discounts,
         CAST(sum(customer_id) AS BIGINT) AS customer_id_sum
  FROM fact_orders GROUP BY 1, 2, 3"""
        ),
        "csv_checked": _query(
            """SELECT unnest(['loaded', 'fields', 'order_date: date', 'order_id: missing', 'discount_pct: decimal(5,2)']) AS reason,
         unnest([good, torn, day, lost, rate]) AS rows, unnest([total, NULL, NULL, NULL, NULL]) AS customer_id_sum
  FROM (SELECT count(*) FILTER (NOT (d OR t OR k OR r)) AS good, count(*) FILTER (t) AS torn, count(*) FILTER (d AND NOT t) AS day,
               count(*) FILTER (k AND NOT t) AS lost, count(*) FILTER (r AND NOT t) AS rate,
               CAST(sum(customer_id) FILTER (NOT (d OR t OR k OR r)) AS BIGINT) AS total
        FROM (SELECT customer_id, order_id % 101 = 0 AS d, order_id % 103 = 0 AS t, order_id % 107 = 0 AS k, order_id % 109 = 0 AS r
              FROM fact_orders))"""
        ),
        "dq_primary_key": _query(" UNION ALL ".join(_pk(*k) for k in _KEYS)),
        "dq_foreign_key": _query(" UNION ALL ".join(_fk(*k) for k in _REFERENCES)),
        "orders_without_items": _query(
            """SELECT order_status, count(order_id) AS orders
  FROM fact_orders o ANTI JOIN fact_order_items USING (order_id) GROUP BY 1"""
        ),
        "calendar_dim": _query("SELECT * FROM dim_date"),
        "ab_tagging": _query(
            """SELECT o.order_id, c.ab_test_group,
         o.order_date BETWEEN DATE '1998-01-01' AND DATE '1998-03-31' AS in_ab_test,
         CASE WHEN o.order_date BETWEEN DATE '1998-01-01' AND DATE '1998-03-31' AND c.ab_test_group = 'treatment'
              THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END AS discount_pct
  FROM fact_orders o LEFT JOIN dim_customers c USING (customer_id)"""
        ),
        "line_totals": _query(
            """SELECT i.order_item_id, i.order_id, i.product_id, i.quantity, CAST(p.unit_price AS DOUBLE) AS unit_price,
         CAST(o.discount_pct AS DOUBLE) AS discount_pct,
         CAST(round_even(p.unit_price * i.quantity * (1 - o.discount_pct), 2) AS DOUBLE) AS line_total
  FROM fact_order_items i LEFT JOIN dim_products p USING (product_id) LEFT JOIN fact_orders o USING (order_id)"""
        ),
        "order_values": _query(
            "SELECT order_id, customer_id, order_date, CAST(order_value AS DOUBLE) AS order_value FROM completed_values",
            _VALUES,
        ),
        "stored_order_values": _query(
            "SELECT order_id, customer_id, order_date, CAST(order_value AS DOUBLE) AS order_value FROM completed_values",
            _VALUES,
        ),
        "rfm_raw": _query(f"SELECT {_RFM_COLUMNS}, last_order_date FROM rfm_raw", _RFM),
        "rfm_scores": _query(f"SELECT {_RFM_COLUMNS}, r_score, f_score, m_score FROM rfm_scores", _RFM),
        "rfm_segments": _query(
            f"SELECT {_RFM_COLUMNS}, r_score, f_score, m_score, rfm_total, rfm_segment FROM rfm_segments "
            "ORDER BY rfm_total DESC, customer_id",
            _RFM,
        ),
        "scalar_subquery_recency": _query("SELECT customer_id, recency_days FROM rfm_raw", _RFM),
        "top_customers": _query(
            f"SELECT {_RFM_COLUMNS} FROM rfm_raw r ORDER BY r.monetary DESC, customer_id LIMIT 100", _RFM
        ),
        "cohort_retention": _query(
            """SELECT strftime(a.cohort, '%Y-%m') AS cohort_month, a.month_index,
         count(DISTINCT a.customer_id) AS active_customers, s.n AS cohort_customers,
         round(100.0::DOUBLE * count(DISTINCT a.customer_id) / s.n, 1) AS retention_pct
  FROM activity a JOIN (SELECT cohort, count(DISTINCT customer_id) AS n FROM cohorts GROUP BY 1) s ON s.cohort = a.cohort
  GROUP BY a.cohort, a.month_index, s.n ORDER BY 1, 2""",
            _COHORT,
        ),
        "cohort_heatmap": _query(
            f"SELECT strftime(cohort, '%Y-%m') AS cohort_month, {heat} FROM activity GROUP BY 1", _COHORT
        ),
        "active_customers": _query(
            """SELECT acquisition_channel, count(DISTINCT customer_id) AS active_customers
  FROM activity JOIN dim_customers USING (customer_id) GROUP BY 1
  UNION ALL SELECT NULL, count(DISTINCT customer_id) FROM activity""",
            _COHORT,
        ),
        "cohort_pct_of_total": _query(
            """SELECT strftime(cohort, '%Y-%m') AS cohort_month, month_index, count(DISTINCT customer_id) AS active_customers,
         round(count(DISTINCT customer_id) / CAST(sum(count(DISTINCT customer_id)) OVER (PARTITION BY cohort) AS DOUBLE), 6)
           AS pct_of_total
  FROM activity GROUP BY cohort, month_index""",
            _COHORT,
        ),
        "revenue_growth": _query("SELECT * FROM growth ORDER BY month", _GROWTH),
        "rollup_growth": _query("SELECT * FROM growth ORDER BY month", _GROWTH),
        "latest_month": _query(
            "SELECT month, revenue, mom_growth_pct, yoy_growth_pct FROM growth ORDER BY month DESC LIMIT 1", _GROWTH
        ),
        "calendar_growth": _query(
            """SELECT strftime(n.month, '%Y-%m') AS month, CAST(n.revenue AS DOUBLE) AS completed_revenue,
         CAST(p.revenue AS DOUBLE) AS revenue_prior_month,
         round(CAST(n.revenue - p.revenue AS DOUBLE) / nullif(CAST(p.revenue AS DOUBLE), 0), 6) AS mom_growth,
         CAST(y.revenue AS DOUBLE) AS revenue_same_month_last_year,
         round(CAST(n.revenue - y.revenue AS DOUBLE) / nullif(CAST(y.revenue AS DOUBLE), 0), 6) AS yoy_growth
  FROM months n
  LEFT JOIN months p ON p.month = n.month - INTERVAL 1 MONTH
  LEFT JOIN months y ON y.month = n.month - INTERVAL 12 MONTH""",
            _GROSS_DAILY,
            "months AS (SELECT date_trunc('month', date) AS month, sum(completed_revenue) AS revenue FROM daily GROUP BY 1)",
        ),
        "revenue_mtd": _query(
            """SELECT d.date, CAST(coalesce(r.completed_revenue, 0) AS DOUBLE) AS completed_revenue,
         CAST(sum(coalesce(r.completed_revenue, 0)) OVER
              (PARTITION BY date_trunc('month', d.date) ORDER BY d.date ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS revenue_mtd
  FROM dim_date d LEFT JOIN daily r ON r.date = d.date""",
            _GROSS_DAILY,
        ),
        "kpi_cards": _query(_kpis("dim_customers", "fact_orders", "fact_order_items")),
        "sliced_kpis": _query(_kpis("sliced_customers", "sliced_orders", "sliced_items"), sliced),
        "repeat_purchase_rate": _query(
            """SELECT r.n AS repeat_customers, c.n AS total_customers, round(r.n / c.n::DOUBLE, 6) AS repeat_purchase_rate
  FROM (SELECT count(*) AS n FROM (SELECT customer_id FROM fact_orders GROUP BY 1 HAVING count(order_id) > 1)) r,
       (SELECT count(DISTINCT customer_id) AS n FROM dim_customers) c"""
        ),
        "filtered_measure": _query(
            """SELECT channel, CAST(sum(quantity * unit_price) AS DOUBLE) AS total_revenue,
         CAST(coalesce(sum(quantity * unit_price) FILTER (WHERE order_status = 'Completed'), 0) AS DOUBLE) AS completed_revenue,
         round(CAST(coalesce(sum(quantity * unit_price) FILTER (WHERE order_status = 'Completed'), 0) AS DOUBLE)
               / CAST(sum(quantity * unit_price) AS DOUBLE), 6) AS completed_share
  FROM fact_order_items LEFT JOIN fact_orders USING (order_id) GROUP BY 1"""
        ),
        "revenue_by_category": _query(
            """SELECT p.category, CAST(sum(i.quantity) AS BIGINT) AS units,
         CAST(sum(i.quantity * i.unit_price) AS DOUBLE) AS gross_revenue, CAST(sum(i.line_total) AS DOUBLE) AS net_revenue
  FROM fact_order_items i LEFT JOIN dim_products p USING (product_id) GROUP BY 1"""
        ),
        "star_revenue": _query(
            """SELECT c.country, p.category, d.year, d.is_weekend, CAST(sum(i.line_total) AS DOUBLE) AS net_revenue,
         CAST(sum(i.quantity) AS BIGINT) AS units
  FROM fact_order_items i JOIN fact_orders o USING (order_id) LEFT JOIN dim_customers c USING (customer_id)
  LEFT JOIN dim_products p USING (product_id) LEFT JOIN dim_date d ON d.date = o.order_date
  WHERE o.order_status = 'Completed' GROUP BY 1, 2, 3, 4"""
        ),
        "web_share": _query(
            """SELECT customer_id, count(order_id) AS orders,
         round(avg(CASE WHEN channel = 'Web' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS web_share
  FROM fact_orders WHERE order_status = 'Completed' GROUP BY 1"""
        ),
        "segment_customers": _query("SELECT rfm_segment, count(*) AS customers FROM rfm_segments GROUP BY 1", _RFM),
        "segment_revenue": _query(
            "SELECT rfm_segment, CAST(sum(monetary) AS DOUBLE) AS revenue FROM rfm_segments GROUP BY 1", _RFM
        ),
        "segment_share": _query(
            """SELECT rfm_segment, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS customer_share,
         round(CAST(sum(monetary) AS DOUBLE) / CAST(sum(sum(monetary)) OVER () AS DOUBLE), 6) AS revenue_share
  FROM rfm_segments GROUP BY 1""",
            _RFM,
        ),
        "segment_breakdown": _query(
            """SELECT rfm_segment, count(*) AS customers, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 3) AS pct_of_base,
         CAST(sum(monetary) AS DOUBLE) AS total_revenue, round(CAST(sum(monetary) AS DOUBLE) / count(*), 0) AS avg_monetary,
         round(CAST(sum(recency_days) AS DOUBLE) / count(*), 1) AS avg_recency_days
  FROM rfm_segments GROUP BY 1""",
            _RFM,
        ),
        "segment_drill": _query(f"SELECT {_RFM_COLUMNS} FROM rfm_segments WHERE rfm_segment = 'At Risk'", _RFM),
        "labelled_customers": _query("SELECT customer_id, r_score - 1 AS cluster, segment_label FROM labelled", _RFM, _LABELS),
        "label_profile": _query(
            """SELECT cluster, segment_label, recency_days, frequency, monetary, customers FROM profile JOIN labels USING (cluster)""",
            _RFM,
            _LABELS,
        ),
        "label_customers": _query("SELECT segment_label, count(*) AS customers FROM labelled GROUP BY 1", _RFM, _LABELS),
        "label_revenue": _query(
            "SELECT segment_label, CAST(sum(monetary) AS DOUBLE) AS revenue FROM labelled GROUP BY 1", _RFM, _LABELS
        ),
        "label_share": _query(
            """SELECT segment_label, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS customer_share,
         round(CAST(sum(monetary) AS DOUBLE) / CAST(sum(sum(monetary)) OVER () AS DOUBLE), 6) AS revenue_share
  FROM labelled GROUP BY 1""",
            _RFM,
            _LABELS,
        ),
        "label_breakdown": _query(
            """SELECT segment_label, count(*) AS customers, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 3) AS pct_of_base,
         CAST(sum(monetary) AS DOUBLE) AS total_revenue, round(CAST(sum(monetary) AS DOUBLE) / count(*), 0) AS avg_monetary,
         round(CAST(sum(recency_days) AS DOUBLE) / count(*), 1) AS avg_recency_days
  FROM labelled GROUP BY 1""",
            _RFM,
            _LABELS,
        ),
        "sql_views": _query(
            """SELECT c.country, o.channel, count(*) AS orders, count(DISTINCT o.customer_id) AS customers
  FROM fact_orders o JOIN dim_customers c USING (customer_id) WHERE o.order_status = 'Completed' GROUP BY 1, 2"""
        ),
        "exec_kpis": _query(
            """SELECT r.n AS total_customers, CAST(r.m AS DOUBLE) AS total_revenue,
         round(CAST(r.m AS DOUBLE) / r.f, 2) AS avg_order_value_proxy, g.revenue AS latest_month_revenue,
         g.mom_growth_pct AS latest_month_mom_growth_pct, g.yoy_growth_pct AS latest_month_yoy_growth_pct
  FROM (SELECT count(*) AS n, sum(monetary) AS m, sum(frequency) AS f FROM rfm_raw) r,
       (SELECT * FROM growth ORDER BY month DESC LIMIT 1) g""",
            _RFM,
            _GROWTH.removeprefix(f"{_VALUES},\n"),
        ),
        "ab_readout": _query(
            """SELECT ab_test_group, count(DISTINCT customer_id) AS customers_who_ordered, count(order_id) AS total_orders,
         round(CAST(sum(order_value) AS DOUBLE) / count(order_id), 2) AS avg_order_value,
         CAST(round(sum(order_value), 2) AS DOUBLE) AS total_revenue
  FROM completed_values WHERE in_ab_test GROUP BY 1""",
            _VALUES,
        ),
        "ab_conversion": _query(
            "SELECT ab_test_group, converted, n AS customers, round(rate, 6) AS conversion_rate FROM by_customer", _AB
        ),
        "ab_ztest": _query(
            f"""SELECT round(cr, 6) AS control_rate, round(tr, 6) AS treatment_rate, round(z, 6) AS z_stat,
         (SELECT round(p, 6) FROM judged WHERE metric = 'Conversion Rate') AS p_value FROM ({_ZTEST})""",
            _SUMMARY,
        ),
        "ab_revenue_per_customer": _query(welch.format("Revenue per Customer", _welch("by_customer")), _SUMMARY),
        "ab_aov": _query(welch.format("Average Order Value", _welch("by_order")), _SUMMARY),
        "ab_mde": _query(
            f"""SELECT n AS n_per_group, round(rate, 6) AS baseline_rate,
         round({z_sum!r}::DOUBLE * sqrt(2 * rate * (1 - rate) / n), 6) AS minimum_detectable_effect
  FROM by_customer WHERE ab_test_group = 'control'""",
            _AB,
        ),
        "ab_summary": _query(
            """SELECT metric, round(control, 6) AS control, round(treatment, 6) AS treatment, round(p, 6) AS p_value,
         p < 0.05 AS significant_at_0_05 FROM judged""",
            _SUMMARY,
        ),
        "promo_scenario": _query(
            "SELECT * FROM scenario", _scenario("unnest([0.00, 0.05, 0.10, 0.15, 0.20, 0.25, 0.30]::DOUBLE[])")
        ),
        "promo_grid": _query("SELECT * FROM scenario", _scenario("unnest(range(31)) / 100.0::DOUBLE")),
        "promo_best_discount": _query(
            "SELECT discount, projected_margin, projected_revenue FROM scenario ORDER BY projected_margin DESC, discount LIMIT 1",
            _scenario("unnest(range(31)) / 100.0::DOUBLE"),
        ),
        "eligible_customers": _query(
            """SELECT customer_id, signup_date FROM dim_customers c
  WHERE signup_date <= (SELECT max(signup_date) - 181 FROM dim_customers)
    AND EXISTS (SELECT 1 FROM fact_orders o WHERE o.customer_id = c.customer_id AND o.order_status = 'Completed')"""
        ),
        "clv_features": _query("SELECT * FROM clv", _CLV),
        "churn_features": _query("SELECT * FROM churn", _CHURN),
        "churn_base_rate": _query(
            "SELECT count(customer_id) AS active_customers, round(avg(churned), 6) AS churn_rate FROM churn", _CHURN
        ),
        "clv_split": _query(f"SELECT customer_id, {_HASH} % 100 < 20 AS is_test FROM clv", _CLV),
        "churn_split": _query("SELECT customer_id, churned, is_test FROM churn_split", _CHURN_SPLIT),
        "churn_class_weight": _query(
            """SELECT stayed, churned, round(stayed / churned::DOUBLE, 6) AS class_weight
  FROM (SELECT count(*) FILTER (WHERE churned = 0) AS stayed, count(*) FILTER (WHERE churned = 1) AS churned
        FROM churn_split WHERE NOT is_test)""",
            _CHURN_SPLIT,
        ),
        "churn_one_hot": _query(
            """SELECT customer_id, CAST(g.column AS INT) AS column, CAST(value AS DOUBLE) AS value FROM (
    SELECT customer_id, 0 AS column, CAST(age AS DOUBLE) AS value FROM churn UNION ALL SELECT customer_id, 1, orders_0_180 FROM churn
    UNION ALL SELECT customer_id, 2, spend_0_180 FROM churn UNION ALL SELECT customer_id, 3, avg_order_value FROM churn
    UNION ALL SELECT customer_id, 4, channel_web_share FROM churn
    UNION ALL SELECT customer_id, 3 + n, CAST(acquisition_channel = level AS INT) FROM churn, levels WHERE kind = 'channel' AND n > 1
    UNION ALL SELECT customer_id, 2 + (SELECT count(*) FROM levels WHERE kind = 'channel') + n, CAST(country = level AS INT)
      FROM churn, levels WHERE kind = 'country' AND n > 1) g""",
            _CHURN_SPLIT,
            """trained AS (SELECT c.* FROM churn c JOIN churn_split s USING (customer_id) WHERE NOT s.is_test),
levels AS (SELECT 'channel' AS kind, acquisition_channel AS level, row_number() OVER (ORDER BY acquisition_channel) AS n
           FROM (SELECT DISTINCT acquisition_channel FROM trained)
           UNION ALL SELECT 'country', country, row_number() OVER (ORDER BY country) FROM (SELECT DISTINCT country FROM trained))""",
        ),
        "known_clv_metrics": _query(
            f"""SELECT 'clv' AS model, unnest(['train_rows', 'test_rows', 'mae', 'r2']) AS metric, unnest([train_rows, test_rows, round(mae, 9), round(r2, 9)]) AS value
  FROM (SELECT CAST(count(*) FILTER (NOT is_test) AS DOUBLE) AS train_rows, CAST(count(*) FILTER (is_test) AS DOUBLE) AS test_rows,
               avg(abs(spend_next90 - spend_first90)) FILTER (is_test) AS mae,
               1 - sum(power(spend_next90 - spend_first90, 2)) FILTER (is_test)
                   / (var_pop(spend_next90) FILTER (is_test) * count(*) FILTER (is_test)) AS r2
        FROM (SELECT *, {_HASH} % 100 < 20 AS is_test FROM clv))""",
            _CLV,
        ),
        "known_churn_metrics": _query(
            """SELECT 'churn' AS model, unnest(['active_customers', 'base_churn_rate', 'auc_roc']) AS metric, unnest([n, round(rate, 9), round(auc, 9)]) AS value
  FROM (SELECT CAST(count(*) AS DOUBLE) AS n, avg(churned) AS rate FROM known),
       (SELECT avg(CASE WHEN a.p > b.p THEN 1.0::DOUBLE WHEN a.p = b.p THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END) AS auc
        FROM tested a, tested b WHERE a.churned = 1 AND b.churned = 0)""",
            _CHURN_SPLIT,
            _KNOWN,
        ),
        "known_churn_report": _query("SELECT * FROM report", _CHURN_SPLIT, _KNOWN),
        "known_churn_averages": _query(
            """SELECT 'accuracy' AS average, NULL::DOUBLE AS precision, NULL::DOUBLE AS recall,
         (SELECT round(avg(CASE WHEN churned = guess THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) FROM tested) AS f1,
         (SELECT count(*) FROM tested) AS support
  UNION ALL SELECT 'macro', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM report
  UNION ALL SELECT 'weighted', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
         round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM report""",
            _CHURN_SPLIT,
            _KNOWN,
        ),
        "known_churn_top100": _query(
            """SELECT customer_id, CAST(round_even(CAST(p AS DECIMAL(12,10)), 3) AS DOUBLE) AS churn_probability, orders_0_180, spend_0_180
  FROM known ORDER BY churn_probability DESC, customer_id LIMIT 100""",
            _CHURN_SPLIT,
            _KNOWN,
        ),
        "signup_cohorts": _query(
            """SELECT strftime(a.cohort, '%Y-%m') AS cohort_month, a.month_index,
         count(DISTINCT a.customer_id) AS active_customers, s.n AS cohort_customers,
         round(100.0::DOUBLE * count(DISTINCT a.customer_id) / s.n, 1) AS retention_pct
  FROM activity a JOIN (SELECT cohort, count(DISTINCT customer_id) AS n FROM cohorts GROUP BY 1) s ON s.cohort = a.cohort
  GROUP BY a.cohort, a.month_index, s.n ORDER BY 1, 2""",
            _COHORT.replace("FROM dim_customers", f"FROM dim_customers WHERE {_SIGNED_UP}"),
        ),
        "signup_segments": _query(
            "SELECT rfm_segment, count(*) AS customers FROM rfm_segments GROUP BY 1",
            _RFM.replace("WHERE o.order_status", f"JOIN dim_customers c ON c.customer_id = o.customer_id AND {_SIGNED_UP} WHERE o.order_status"),
        ),
        "rfm_features_scaled": _query(
            """SELECT customer_id, round(recency_scaled, 6) + 0.0 AS recency_scaled,
         round(frequency_scaled, 6) + 0.0 AS frequency_scaled, round(monetary_scaled, 6) + 0.0 AS monetary_scaled FROM scaled""",
            _RFM,
            _SCALED,
        ),
        "kmeans_step": _query(
            """SELECT id AS rfm_segment, count(*) AS customers, round(sum(d), 6) AS inertia,
         round(avg(recency_scaled), 6) + 0.0 AS recency_scaled, round(avg(frequency_scaled), 6) + 0.0 AS frequency_scaled,
         round(avg(monetary_scaled), 6) + 0.0 AS monetary_scaled
  FROM (SELECT s.*, c.id, power(s.recency_scaled - c.r, 2) + power(s.frequency_scaled - c.f, 2) + power(s.monetary_scaled - c.m, 2) AS d
        FROM scaled s, centroids c QUALIFY row_number() OVER (PARTITION BY s.customer_id ORDER BY d, c.id) = 1) GROUP BY 1""",
            _RFM,
            _SCALED,
            _CENTROIDS,
        ),
        "known_tree_scores": _query(
            "SELECT customer_id, margin, round(1 / (1 + exp(-2 * margin)), 9) AS probability FROM margins", _CHURN, _WALK
        ).replace("WITH ", "WITH RECURSIVE ", 1),
        "known_tree_importance": _query(
            f"""SELECT feature, round(coalesce(gained, 0) / total, 9) AS importance, mean FROM (
    SELECT unnest({KNOWN_FEATURES}) AS feature, unnest(range({len(KNOWN_FEATURES)})) AS number,
           unnest([{", ".join(f"round(avg({c}::DOUBLE), 6)" for c in KNOWN_FEATURES)}]) AS mean FROM churn)
  LEFT JOIN (SELECT feature AS number, sum(gain * met) AS gained FROM nodes WHERE feature >= 0 GROUP BY 1) USING (number),
  (SELECT sum(gain * met) AS total FROM nodes WHERE feature >= 0)""",
            _CHURN,
            _NODES,
        ),
        "kmeans_assign": _query(
            """SELECT s.customer_id, s.rfm_segment,
         arg_min(c.id, (power(s.recency_scaled - c.r, 2) + power(s.frequency_scaled - c.f, 2)
                        + power(s.monetary_scaled - c.m, 2), c.id)) AS nearest_segment
  FROM scaled s, centroids c GROUP BY 1, 2""",
            _RFM,
            _SCALED,
            _CENTROIDS,
        ),
    }
