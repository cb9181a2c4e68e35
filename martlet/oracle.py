"""DuckDB SQL for every registered query, over the supplied tables.

The fixture mapping (``martlet.sources.fixtures``) and the model layers
are written once here as named CTEs from the model's rules, by other
methods than the Spark plans take (NOT EXISTS for the review rule, anti
joins, windows for order totals, a table of bucket bounds), so they are a
second opinion. ``sql(body, needs)`` prepends the CTEs a
query uses, dependencies first.

``present`` wraps a query so both engines return comparable values:
decimals as DOUBLE, dates as 'yyyy-MM-dd', timestamps with microseconds,
computed doubles rounded to 6 decimals (interpolation formulas differ in
the last bit between engines).
"""

from __future__ import annotations

SCOPE = ("TIMESTAMP '1996-01-01 00:00:00'", "TIMESTAMP '2000-09-01 00:00:00'")
IN_SCOPE = (f"o.status IN ('delivered', 'shipped') AND o.purchased_at >= {SCOPE[0]} "
            f"AND o.purchased_at < {SCOPE[1]}")

CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    # ---- supplied tables -> staged sources -------------------------------
    "stg_order_items": ("""
SELECT l_orderkey AS order_id,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
            l_shipdate, l_extendedprice, l_quantity, l_tax) AS INTEGER) AS order_item_id,
       l_partkey AS product_id,
       l_suppkey AS seller_id,
       l_shipdate AS shipping_limit_at,
       CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
       CAST(round(CAST(l_extendedprice AS DECIMAL(10,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)
            AS DECIMAL(10,2)) AS freight_value
FROM lineitem""", ()),
    "ship": ("""
SELECT l.l_orderkey,
       min(l.l_shipdate) AS first_ship,
       min(CASE WHEN l.l_shipdate >= o.o_orderdate THEN l.l_shipdate END) AS first_ship_after_order
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
GROUP BY l.l_orderkey""", ()),
    "stg_orders": ("""
SELECT o.o_orderkey AS order_id,
       o.o_custkey AS customer_id,
       CASE o.o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
            WHEN 'P' THEN 'canceled' END AS status,
       o.o_orderdate AS purchased_at,
       o.o_orderdate AS approved_at,
       s.first_ship AS carrier_handover_at,
       CASE WHEN o.o_orderstatus = 'F' THEN s.first_ship_after_order END AS delivered_at,
       o.o_orderdate + to_days(CASE substr(o.o_orderpriority, 1, 1) WHEN '1' THEN 3 WHEN '2' THEN 14
            WHEN '3' THEN 30 WHEN '4' THEN 90 WHEN '5' THEN 365 END) AS estimated_delivery_at
FROM orders o LEFT JOIN ship s ON o.o_orderkey = s.l_orderkey""", ("ship",)),
    "stg_order_reviews": ("""
SELECT event_id AS review_id,
       (event_id * 7) // 10 AS order_id,
       CAST(CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3
            WHEN 'signup' THEN 4 WHEN 'purchase' THEN 5 END AS INTEGER) AS review_score,
       CAST(NULL AS VARCHAR) AS comment_title,
       props AS comment_message,
       CAST(date_trunc('day', ts) AS TIMESTAMP) AS created_at,
       ts AS answered_at
FROM events""", ()),
    "pay_base": ("""
SELECT order_id,
       CAST(sum(price + freight_value)
            + CASE WHEN order_id % 97 = 0 THEN 0.50 ELSE 0.00 END
            + CASE WHEN order_id % 89 = 0 THEN 5.00 ELSE 0.00 END AS DECIMAL(10,2)) AS total
FROM stg_order_items GROUP BY order_id""", ("stg_order_items",)),
    "stg_order_payments": ("""
SELECT order_id, CAST(1 AS INTEGER) AS payment_sequential,
       CASE WHEN order_id % 2 = 0 THEN 'boleto' ELSE 'credit_card' END AS payment_type,
       CAST(1 AS INTEGER) AS payment_installments,
       CAST(CASE WHEN order_id % 5 = 0 THEN total - 1.00 ELSE total END AS DECIMAL(10,2)) AS payment_value
FROM pay_base
UNION ALL
SELECT order_id, CAST(2 AS INTEGER), CASE WHEN order_id % 2 = 0 THEN 'boleto' ELSE 'credit_card' END,
       CAST(1 AS INTEGER), CAST(1.00 AS DECIMAL(10,2))
FROM pay_base WHERE order_id % 5 = 0""", ("pay_base",)),
    "stg_customers": ("""
SELECT c.c_custkey AS customer_id,
       (c.c_custkey * 9) // 10 AS customer_unique_id,
       CAST(c.c_nationkey AS VARCHAR) AS zip_code_prefix,
       c.c_mktsegment AS city,
       n.n_name AS state
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""", ()),
    "stg_products": ("""
SELECT p_partkey AS product_id,
       CASE WHEN p_type <> 'PROMO' THEN p_type END AS category_name_pt,
       CAST(p_size AS DOUBLE) AS weight_g,
       CAST(NULL AS DOUBLE) AS length_cm,
       CAST(NULL AS DOUBLE) AS height_cm,
       CAST(NULL AS DOUBLE) AS width_cm
FROM part""", ()),
    "stg_sellers": ("""
SELECT s.s_suppkey AS seller_id,
       CAST(s.s_nationkey AS VARCHAR) AS zip_code_prefix,
       s.s_name AS city,
       n.n_name AS state
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""", ()),
    "raw_translation": ("""
SELECT DISTINCT p_type AS category_name_pt, lower(p_type) AS category_name_en
FROM part WHERE p_type NOT IN ('PROMO', 'LARGE')""", ()),
    "stg_category_translation": ("""
SELECT category_name_pt, category_name_en FROM raw_translation
UNION ALL
SELECT 'LARGE', 'large'""", ("raw_translation",)),
    "geolocation": ("""
SELECT CAST(c.c_nationkey AS VARCHAR) AS zip_code_prefix,
       c.c_acctbal AS lat,
       c.c_acctbal / 2 AS lng,
       c.c_mktsegment AS city,
       n.n_name AS state
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""", ()),
    "geo_in_bounds": ("""
SELECT * FROM geolocation WHERE lat BETWEEN 0.0 AND 9000.0""", ("geolocation",)),
    # ---- marts --------------------------------------------------------------
    "dim_date": ("""
SELECT CAST(d AS DATE) AS date_key,
       CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month_number,
       strftime(d, '%B') AS month_name,
       strftime(d, '%Y-%m') AS year_month,
       CAST(day(d) AS INTEGER) AS day_of_month,
       CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week_number,
       strftime(d, '%A') AS day_of_week_name,
       dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT unnest(generate_series(CAST(date_trunc('year', min(o_orderdate)) AS DATE),
                                    make_date(CAST(year(max(o_orderdate)) AS BIGINT), 12, 31),
                                    INTERVAL 1 DAY)) AS d
      FROM orders) dates""", ()),
    "dim_customer": ("""
SELECT customer_id, customer_unique_id, city, state FROM stg_customers""", ("stg_customers",)),
    "dim_product": ("""
SELECT product_id, ifnull(category_name_pt, 'unknown') AS category_name_pt,
       ifnull((SELECT any_value(t.category_name_en) FROM stg_category_translation t
               WHERE t.category_name_pt = stg_products.category_name_pt), 'unknown') AS category_name_en,
       weight_g, length_cm, height_cm, width_cm
FROM stg_products""", ("stg_products", "stg_category_translation")),
    "dim_seller": ("""
SELECT seller_id, city, state FROM stg_sellers""", ("stg_sellers",)),
    "scoped": (f"""
SELECT order_id, customer_id, status, purchased_at::DATE AS date_key
FROM stg_orders SEMI JOIN (VALUES ('delivered'), ('shipped')) AS s(status) USING (status)
WHERE epoch_us(purchased_at) BETWEEN epoch_us({SCOPE[0]}) AND epoch_us({SCOPE[1]}) - 1""", ("stg_orders",)),
    "fct_order_items": ("""
SELECT * EXCLUDE (price, freight_value, shipping_limit_at, status),
       price AS revenue_net, freight_value AS freight_cost,
       price + freight_value AS revenue_gross, price - freight_value AS contribution_after_freight
FROM scoped NATURAL JOIN stg_order_items""", ("stg_order_items", "scoped")),
    "last_review": ("""
SELECT order_id, review_score FROM stg_order_reviews r
WHERE NOT EXISTS (SELECT 1 FROM stg_order_reviews o WHERE o.order_id = r.order_id
                  AND (o.created_at > r.created_at OR o.created_at = r.created_at AND o.review_id < r.review_id))""",
                    ("stg_order_reviews",)),
    "order_sums": ("""
SELECT DISTINCT order_id, sum(revenue_net) OVER per AS revenue_net, sum(freight_cost) OVER per AS freight_cost,
       sum(contribution_after_freight) OVER per AS contribution_after_freight, count(*) OVER per AS item_count
FROM fct_order_items WINDOW per AS (PARTITION BY order_id)""", ("fct_order_items",)),
    "arrived": ("""
SELECT order_id, CAST(delivered_at::DATE - purchased_at::DATE AS INTEGER) AS delivery_days,
       delivered_at > estimated_delivery_at AS is_late
FROM stg_orders WHERE status = 'delivered' AND delivered_at IS NOT NULL""", ("stg_orders",)),
    "fct_orders": ("""
SELECT *, review_score < 3 AS is_negative_review
FROM scoped NATURAL JOIN order_sums LEFT JOIN arrived USING (order_id) LEFT JOIN last_review USING (order_id)""",
                   ("scoped", "order_sums", "arrived", "last_review")),
    "fct_orders_ext": ("""
SELECT f.*,
       CASE WHEN f.delivery_days IS NOT NULL
            THEN (epoch_us(o.delivered_at) - epoch_us(o.purchased_at)) / 86400e6 END AS delivery_days_exact,
       coalesce(o.carrier_handover_at < o.approved_at OR o.delivered_at < o.carrier_handover_at
                OR o.approved_at < o.purchased_at OR o.delivered_at < o.purchased_at, false)
            AS has_sequence_violation
FROM fct_orders f JOIN stg_orders o ON f.order_id = o.order_id""", ("fct_orders", "stg_orders")),
    "bucketed": ("""
SELECT f.*, b.delivery_bucket
FROM fct_orders f JOIN (VALUES (-2147483648, 3, '0-3'), (4, 7, '4-7'), (8, 14, '8-14'), (15, 21, '15-21'),
                               (22, 30, '22-30'), (31, 2147483647, '31+')) AS b(lo, hi, delivery_bucket)
  ON f.delivery_days BETWEEN b.lo AND b.hi""", ("fct_orders",)),
}


#: The flawed variant of the sources (``fixtures.FlawedSources``): these CTEs over the ones above.
_FLAWS = {
    "stg_orders": """
SELECT * REPLACE (delivered_at + to_minutes(order_id * 37 % 1440) AS delivered_at,
                  customer_id + if(order_id % 53 = 0, 10000000, 0) AS customer_id) FROM sound_stg_orders""",
    "stg_order_items": """
SELECT * REPLACE (product_id + if(product_id % 41 = 0, 10000000, 0) AS product_id,
                  if(order_id % 67 = 0, NULL, seller_id) AS seller_id) FROM sound_stg_order_items""",
    "stg_order_payments": """
SELECT * REPLACE (CASE WHEN order_id % 71 = 0 THEN 'not_defined' WHEN order_id % 73 <> 0 THEN payment_type END AS payment_type)
FROM sound_stg_order_payments""",
    "stg_customers": """
SELECT * REPLACE ([lower(city), '  ' || city, city || ' ', city][1 + customer_id % 4] AS city) FROM sound_stg_customers""",
    "stg_sellers": """
SELECT * REPLACE (if(CAST(zip_code_prefix AS INTEGER) % 3 = 0, NULL, state) AS state) FROM sound_stg_sellers""",
}
FLAWED = CTES | {f"sound_{n}": CTES[n] for n in _FLAWS} | {n: (text, (f"sound_{n}",)) for n, text in _FLAWS.items()}


class Query(str):
    """A query's text; ``flawed``: the same over the flawed sources."""

    flawed: str

    def __new__(cls, text: str, flawed: str):
        q = super().__new__(cls, text)
        q.flawed = flawed
        return q


def _resolve(needs, ctes) -> list[str]:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in ctes[n][1]:
            visit(d)
        order.append(n)
    for n in needs:
        visit(n)
    return order


def _with(body: str, needs, ctes) -> str:
    names = _resolve(needs, ctes)
    if not names:
        return body.strip()
    return f"WITH {',\n'.join(f'{n} AS ({ctes[n][0].strip()})' for n in names)}\n{body.strip()}"


def sql(body: str, needs) -> Query:
    return Query(_with(body, needs, CTES), _with(body, needs, FLAWED))


def present(query: str, money=(), dates=(), ts=(), dbl=()) -> str:
    """Wrap ``query`` with the comparison formatting (see module doc)."""
    repl = ([f"CAST({c} AS DOUBLE) AS {c}" for c in money]
            + [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates]
            + [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}" for c in ts]
            + [f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in dbl])
    if not repl:
        return query
    if isinstance(query, Query):
        return Query(present(str(query), money, dates, ts, dbl), present(query.flawed, money, dates, ts, dbl))
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM (\n{query}\n) q"
