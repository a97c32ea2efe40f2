"""DuckDB SQL for the binding, staging, intermediate models and marts.

Each entry is ``name -> (dependencies, select statement)``; :func:`compose` emits
one ``WITH`` query holding the transitive dependencies in order. The views
``region nation customer part orders lineitem events`` are pre-registered.
"""

from __future__ import annotations

from oracle.fixed import BAND_EDGES, BAND_LABELS

MODELS: dict[str, tuple[list[str], str]] = {}


def model(name: str, deps: list[str], sql: str) -> None:
    MODELS[name] = (deps, sql)


def _order(targets: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in MODELS[n][0]:
            visit(d)
        seen.append(n)

    for t in targets:
        visit(t)
    return seen


def compose(select: str, deps: list[str]) -> str:
    names = _order(deps)
    ctes = ",\n".join(f"{n} AS (\n{MODELS[n][1]}\n)" for n in names)
    return f"WITH {ctes}\n{select}" if names else select


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def per(num: str, den: str, places: int | None = None) -> str:
    """num / den in doubles, NULL for a zero denominator."""
    q = f"{dbl(num)} / nullif({dbl(den)}, 0)"
    return q if places is None else f"round({q}, {places})"


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(38,2))"


def pence(x: str) -> str:
    """A double rounded to pence, as the line money type."""
    return f"CAST(round({x}, 2) AS DECIMAL(14,2))"


ITEM_ID = ("concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR), "
           "CAST(l.l_partkey AS VARCHAR), CAST(l.l_suppkey AS VARCHAR), "
           "CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR), "
           "CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) AS VARCHAR))")

#: A line's discount; orders with key 7 modulo 50 are given away.
DISCOUNT = ("CAST(CASE WHEN l.l_orderkey % 50 = 7 "
            "THEN CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_quantity AS INTEGER) "
            "ELSE round(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_quantity AS INTEGER) "
            "* CAST(l.l_discount AS DECIMAL(4,2)), 2) END AS DECIMAL(12,2))")

# ------------------------------------------------------------------ binding
model("b_geo", [], """
SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")

model("b_customer", ["b_geo"], """
SELECT c.c_custkey, c.c_mktsegment, c.c_acctbal, g.n_name, g.r_name,
       f.first_date - CAST(c.c_custkey % 45 AS INTEGER) AS signup_date
FROM customer c
LEFT JOIN b_geo g ON c.c_nationkey = g.n_nationkey
LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first_date
           FROM orders GROUP BY o_custkey) f ON c.c_custkey = f.o_custkey""")

model("raw_customers", ["b_customer"], """
SELECT c_custkey AS customer_id, signup_date, c_mktsegment AS acquisition_channel,
       n_name AS country, r_name AS region, n_name AS city,
       CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS marketing_opt_in
FROM b_customer""")

model("raw_products", [], """
SELECT p_partkey AS product_id, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku,
       p_name AS product_name, p_type AS category, concat_ws(' ', p_type, p_brand) AS subcategory,
       p_brand AS brand,
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 50 AS DECIMAL(12,2)) AS unit_cost,
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 60 AS DECIMAL(12,2)) AS list_price,
       CAST(p_size AS DECIMAL(8,2)) AS weight_kg
FROM part""")

model("b_line_agg", [], """
SELECT l_orderkey, sum(l_quantity) AS order_qty, max(CAST(l_shipdate AS DATE)) AS last_ship_date
FROM lineitem GROUP BY l_orderkey""")

model("b_order_hdr", ["b_customer", "b_line_agg"], """
SELECT o.o_orderkey AS order_id, o.o_custkey + (o.o_custkey % 10 = 0)::INTEGER AS customer_id,
       CAST(o.o_orderdate AS DATE) AS order_date, o.o_orderpriority AS order_channel,
       CASE WHEN o.o_orderstatus <> 'P' THEN 1 ELSE 0 END AS is_shipped,
       CASE WHEN o.o_orderstatus <> 'P' THEN c.r_name ELSE 'Store Pickup' END AS fulfilment_centre,
       CASE WHEN o.o_orderstatus <> 'P' THEN 'Carrier ' || CAST(o.o_orderkey % 3 AS VARCHAR) END AS carrier,
       CASE WHEN o.o_orderstatus <> 'P'
            THEN CAST(o.o_orderdate AS DATE) + CAST(2 + o.o_orderkey % 4 AS INTEGER) END AS promised_delivery_date,
       CASE WHEN o.o_orderstatus <> 'P'
            THEN CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 2 AS INTEGER) END AS shipped_date,
       CASE WHEN o.o_orderstatus <> 'P'
            THEN CAST(o.o_orderdate AS DATE)
                 + CAST(1 + abs(date_diff('day', CAST(o.o_orderdate AS DATE), la.last_ship_date)) % 8 AS INTEGER)
       END AS delivered_date,
       CASE WHEN o.o_totalprice >= 100000 THEN CAST(0 AS DECIMAL(12,2))
            ELSE CAST(4.99 AS DECIMAL(12,2)) END AS shipping_fee_charged,
       CAST(CAST(coalesce(la.order_qty, 0) AS DECIMAL(12,0)) * CAST(0.05 AS DECIMAL(3,2))
            + CAST(1.50 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS shipping_cost,
       CASE o.o_orderkey % 3 WHEN 0 THEN 'Card' WHEN 1 THEN 'Wallet' ELSE 'Gift card' END AS payment_method,
       CASE WHEN o.o_orderkey % 5 = 0 THEN 'SAVE' || CAST(o.o_orderkey % 7 AS VARCHAR) END AS promo_code
FROM orders o
LEFT JOIN b_customer c ON o.o_custkey = c.c_custkey
LEFT JOIN b_line_agg la ON o.o_orderkey = la.l_orderkey""")

model("raw_orders", ["b_order_hdr"], """
SELECT h.*,
       CASE WHEN is_shipped = 0 THEN 'Collected' WHEN delivered_date IS NULL THEN 'Shipped'
            ELSE 'Delivered' END AS order_status,
       CAST(row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS INTEGER)
           AS order_sequence
FROM b_order_hdr h""")

model("raw_order_items", [], f"""
SELECT {ITEM_ID} AS order_item_id, l.l_orderkey AS order_id, l.l_partkey AS product_id,
       CAST(l.l_quantity AS INTEGER) AS quantity,
       CAST(l.l_extendedprice AS DECIMAL(12,2)) AS unit_price,
       {DISCOUNT} AS discount_amount
FROM lineitem l""")

model("raw_returns", ["b_order_hdr"], f"""
SELECT 'RET-' || {ITEM_ID} AS return_id, {ITEM_ID} AS order_item_id,
       coalesce(h.delivered_date, h.order_date) + CAST(2 + l.l_linenumber AS INTEGER) AS return_date,
       CASE WHEN l.l_linenumber % 2 = 0 OR CAST(l.l_quantity AS INTEGER) = 1
            THEN CAST(l.l_quantity AS INTEGER) ELSE 1 END AS quantity_returned,
       'Reason ' || CAST(l.l_linenumber % 6 AS VARCHAR) AS return_reason,
       CASE WHEN l.l_linestatus = 'O' THEN 1 ELSE 0 END AS restocked,
       CAST(round(CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_quantity AS INTEGER)
                       - {DISCOUNT} AS DOUBLE)
                  * (CASE WHEN l.l_linenumber % 2 = 0 OR CAST(l.l_quantity AS INTEGER) = 1
                          THEN CAST(l.l_quantity AS INTEGER) ELSE 1 END)
                  / CAST(l.l_quantity AS INTEGER), 2) AS DECIMAL(12,2)) AS refund_amount
FROM lineitem l JOIN b_order_hdr h ON l.l_orderkey = h.order_id
WHERE l.l_returnflag = 'R'""")

model("raw_marketing_spend", ["b_customer"], """
SELECT signup_date AS spend_date, c_mktsegment AS channel, n_name AS campaign,
       CAST(greatest(c_acctbal, 0) AS DECIMAL(12,2)) AS spend,
       c_custkey % 1000 AS impressions, c_custkey % 100 AS clicks
FROM b_customer""")

# ------------------------------------------------------------------ staging
model("stg_customers", ["raw_customers"], """
SELECT customer_id, CAST(signup_date AS DATE) AS signup_date,
       CAST(date_trunc('month', CAST(signup_date AS DATE)) AS DATE) AS signup_month,
       acquisition_channel, country, region, city,
       CAST(marketing_opt_in AS INTEGER) = 1 AS is_marketing_opt_in
FROM raw_customers""")

model("stg_products", ["raw_products"], """
SELECT product_id, sku, product_name, category, subcategory, brand,
       CAST(unit_cost AS DECIMAL(12,2)) AS unit_cost, CAST(list_price AS DECIMAL(12,2)) AS list_price,
       CAST(weight_kg AS DECIMAL(8,2)) AS weight_kg,
       CAST(round((CAST(list_price AS DOUBLE) - CAST(unit_cost AS DOUBLE))
                  / nullif(CAST(list_price AS DOUBLE), 0), 4) AS DECIMAL(9,4)) AS list_margin_rate
FROM raw_products""")

model("stg_orders", ["raw_orders"], """
SELECT order_id, customer_id, CAST(order_date AS DATE) AS order_date,
       CAST(date_trunc('month', CAST(order_date AS DATE)) AS DATE) AS order_month,
       order_channel, CAST(order_sequence AS INTEGER) AS order_sequence,
       CAST(is_shipped AS INTEGER) = 1 AS is_shipped, fulfilment_centre,
       nullif(carrier, '') AS carrier,
       promised_delivery_date, shipped_date, delivered_date,
       CAST(shipping_fee_charged AS DECIMAL(12,2)) AS shipping_fee_charged,
       CAST(shipping_cost AS DECIMAL(12,2)) AS shipping_cost,
       payment_method, nullif(promo_code, '') AS promo_code, order_status,
       date_diff('day', shipped_date, delivered_date) AS transit_days,
       date_diff('day', CAST(order_date AS DATE), delivered_date) AS days_to_deliver,
       greatest(date_diff('day', promised_delivery_date, delivered_date), 0) AS days_late,
       CASE WHEN delivered_date IS NULL THEN NULL
            WHEN delivered_date <= promised_delivery_date THEN true ELSE false END AS is_on_time
FROM raw_orders""")

model("stg_order_items", ["raw_order_items"], """
SELECT order_item_id, order_id, product_id, CAST(quantity AS INTEGER) AS quantity,
       CAST(unit_price AS DECIMAL(12,2)) AS unit_price,
       CAST(discount_amount AS DECIMAL(12,2)) AS discount_amount,
       CAST(unit_price AS DECIMAL(12,2)) * CAST(quantity AS INTEGER) AS gross_revenue,
       CAST(unit_price AS DECIMAL(12,2)) * CAST(quantity AS INTEGER)
           - CAST(discount_amount AS DECIMAL(12,2)) AS net_revenue,
       CAST(round(CAST(discount_amount AS DOUBLE)
                  / nullif(CAST(unit_price AS DOUBLE) * CAST(quantity AS INTEGER), 0), 4)
            AS DECIMAL(9,4)) AS discount_rate
FROM raw_order_items""")

model("stg_returns", ["raw_returns"], """
SELECT return_id, order_item_id, CAST(return_date AS DATE) AS return_date,
       CAST(quantity_returned AS INTEGER) AS quantity_returned, return_reason,
       CAST(restocked AS INTEGER) = 1 AS is_restocked,
       CAST(refund_amount AS DECIMAL(12,2)) AS refund_amount
FROM raw_returns""")

model("stg_marketing_spend", ["raw_marketing_spend"], """
SELECT CAST(spend_date AS DATE) AS spend_date,
       CAST(date_trunc('month', CAST(spend_date AS DATE)) AS DATE) AS spend_month,
       channel AS acquisition_channel, campaign, CAST(spend AS DECIMAL(12,2)) AS spend,
       CAST(impressions AS BIGINT) AS impressions, CAST(clicks AS BIGINT) AS clicks
FROM raw_marketing_spend""")

# ------------------------------------------------------------- intermediate
# Per-order totals come first; everything about a line is then a join with its order.
model("order_basket", ["stg_order_items"], """
SELECT order_id, sum(net_revenue) AS basket_net, count(*) AS basket_lines
FROM stg_order_items GROUP BY order_id""")

model("basket_allocation", ["stg_order_items", "order_basket"], f"""
SELECT order_item_id, order_id, net_revenue, basket_net AS order_net_revenue,
       basket_lines AS order_line_count,
       if(basket_net > 0, {dbl('net_revenue')} / {dbl('basket_net')},
          {dbl('1.0')} / basket_lines) AS revenue_share
FROM stg_order_items JOIN order_basket USING (order_id)""")

# one return per line at most; units that went back on the shelf need no cost of goods
model("line_return", ["stg_returns"], """
SELECT order_item_id, return_id, return_reason, return_date, is_restocked,
       quantity_returned, refund_amount, quantity_returned * is_restocked::INTEGER AS shelf_units
FROM stg_returns""")

model("line_walk", ["stg_order_items", "basket_allocation", "stg_products", "stg_orders", "line_return"], f"""
SELECT order_item_id, quantity, coalesce(shelf_units, 0) AS back_units, revenue_share,
       {dbl('unit_cost')} AS unit_cost, {dbl('items.net_revenue')} AS net,
       coalesce({dbl('refund_amount')}, 0) AS refund,
       {dbl('shipping_cost')} AS parcel_cost, {dbl('shipping_fee_charged')} AS parcel_fee
FROM stg_order_items AS items
JOIN basket_allocation USING (order_item_id)
JOIN stg_products USING (product_id)
JOIN stg_orders AS parcel ON parcel.order_id = items.order_id
LEFT JOIN line_return USING (order_item_id)""")

model("line_money", ["line_walk"], f"""
SELECT order_item_id,
       {pence('unit_cost * quantity')} AS cogs_gross,
       {pence('unit_cost * back_units')} AS cogs_recovered,
       {pence('unit_cost * (quantity - back_units)')} AS cogs_net,
       {pence('parcel_cost * revenue_share')} AS shipping_cost_allocated,
       {pence('parcel_fee * revenue_share')} AS shipping_fee_allocated,
       {pence('(parcel_cost - parcel_fee) * revenue_share')} AS net_shipping_cost,
       {pence('net - refund')} AS realised_revenue,
       {pence('net - refund - unit_cost * (quantity - back_units) - (parcel_cost - parcel_fee) * revenue_share')}
           AS contribution_margin
FROM line_walk""")

model("order_item_economics", ["line_money", "stg_order_items", "stg_orders", "stg_products", "line_return"], """
SELECT line_money.*,
       items.order_id, items.product_id, items.quantity, items.unit_price, items.gross_revenue,
       items.discount_amount, items.net_revenue, items.discount_rate,
       hdr.customer_id, hdr.order_date, hdr.order_month, hdr.order_channel, hdr.order_sequence,
       hdr.is_shipped, hdr.fulfilment_centre, hdr.carrier, hdr.is_on_time, hdr.days_late, hdr.promo_code,
       stuff.category, stuff.subcategory, stuff.brand, stuff.weight_kg,
       back.return_id IS NOT NULL AS is_returned, back.return_reason, back.return_date,
       coalesce(back.quantity_returned, 0) AS quantity_returned,
       CAST(coalesce(back.refund_amount, 0) AS DECIMAL(12,2)) AS refund_amount,
       coalesce(back.is_restocked, false) AS is_restocked
FROM line_money
JOIN stg_order_items AS items USING (order_item_id)
JOIN stg_orders AS hdr ON hdr.order_id = items.order_id
JOIN stg_products AS stuff ON stuff.product_id = items.product_id
LEFT JOIN line_return AS back ON back.order_item_id = items.order_item_id""")

model("month_spine", ["stg_orders"], """
SELECT CAST(unnest(generate_series(min(order_month), max(order_month), INTERVAL 1 MONTH)) AS DATE) AS month
FROM stg_orders""")

model("first_order_per_customer", ["stg_orders"], """
SELECT DISTINCT ON (customer_id) * FROM stg_orders ORDER BY customer_id, order_date, order_id""")

model("order_value", ["order_item_economics"], """
SELECT order_id, count(*) AS n_lines, sum(quantity) AS n_units, sum(net_revenue) AS net_revenue,
       sum(contribution_margin) AS contribution_margin, sum(refund_amount) AS refunds,
       count(*) FILTER (is_returned) AS n_back
FROM order_item_economics GROUP BY order_id""")

model("order_rollup", ["order_value"], """
SELECT order_id, n_back > 0 AS had_return, net_revenue, contribution_margin FROM order_value""")

# the four labels are two yes/no questions about the first order
model("customer_first_order", ["first_order_per_customer", "order_rollup"], """
SELECT customer_id, o.order_id AS first_order_id, o.order_date AS first_order_date,
       o.order_month AS cohort_month, o.order_channel AS first_order_channel,
       o.fulfilment_centre AS first_order_fulfilment_centre, o.carrier AS first_order_carrier,
       o.is_on_time IS DISTINCT FROM false AS first_order_on_time,
       coalesce(o.days_late, 0) AS first_order_days_late,
       v.had_return IS TRUE AS first_order_returned,
       CAST(coalesce(v.net_revenue, 0) AS DECIMAL(12,2)) AS first_order_net_revenue,
       CAST(coalesce(v.contribution_margin, 0) AS DECIMAL(12,2)) AS first_order_margin,
       if(o.is_on_time IS FALSE, if(v.had_return IS TRUE, 'Late and returned', 'Delivered late'),
          if(v.had_return IS TRUE, 'Returned', 'Clean')) AS first_order_experience
FROM first_order_per_customer AS o LEFT JOIN order_rollup AS v USING (order_id)""")

# -------------------------------------------------------------------- marts
model("customer_orders", ["stg_orders", "order_value"], """
SELECT customer_id, count(*) AS n_orders, sum(n_lines) AS n_lines, sum(n_units) AS n_units,
       sum(net_revenue) AS net, sum(contribution_margin) AS margin, sum(refunds) AS refunds,
       sum(n_back) AS n_back, max(order_date) AS latest
FROM order_value JOIN stg_orders USING (order_id) GROUP BY customer_id""")

model("dim_customer", ["stg_customers", "customer_first_order", "customer_orders", "stg_orders"], f"""
WITH today AS (SELECT max(order_date) AS d FROM stg_orders)
SELECT who.customer_id, signup_date, signup_month, acquisition_channel, region, city, is_marketing_opt_in,
       cohort_month, first_order_date, first_order_channel, first_order_experience,
       first_order_on_time, first_order_returned, first_order_net_revenue,
       CAST(coalesce(n_orders, 0) AS BIGINT) AS orders, CAST(coalesce(n_units, 0) AS BIGINT) AS units,
       {money('coalesce(net, 0)')} AS lifetime_net_revenue,
       {money('coalesce(margin, 0)')} AS lifetime_contribution_margin,
       {money('coalesce(refunds, 0)')} AS lifetime_refunds,
       {per('net', 'n_orders', 2)} AS avg_order_value, {per('n_back', 'n_lines', 4)} AS return_line_rate,
       latest AS last_order_date, coalesce(n_orders > 1, false) AS is_repeat_customer,
       date_diff('month', cohort_month, today.d) AS tenure_months,
       date_diff('day', latest, today.d) AS days_since_last_order,
       coalesce(latest >= today.d - 180, false) AS is_active
FROM today CROSS JOIN stg_customers AS who
LEFT JOIN customer_orders USING (customer_id)
LEFT JOIN customer_first_order AS began ON began.customer_id = who.customer_id""")

model("product_sales", ["order_item_economics"], """
SELECT product_id, count(*) AS n_lines, sum(quantity) AS sold, sum(quantity_returned) AS came_back,
       sum(gross_revenue) AS gross, sum(discount_amount) AS discount, sum(net_revenue) AS net,
       sum(refund_amount) AS refund, sum(cogs_net) AS cogs, sum(net_shipping_cost) AS freight,
       sum(contribution_margin) AS margin
FROM order_item_economics GROUP BY product_id""")

_TOTALS = {"gross": "gross_revenue", "discount": "discount_amount", "net": "net_revenue",
           "refund": "refund_amount", "cogs": "cogs", "freight": "net_shipping_cost",
           "margin": "contribution_margin"}
_COUNTS = {"n_lines": "order_lines", "sold": "units_sold", "came_back": "units_returned"}
model("dim_product", ["stg_products", "product_sales"], f"""
SELECT stg_products.*,
       {', '.join(f'CAST(coalesce({c}, 0) AS BIGINT) AS {n}' for c, n in _COUNTS.items())},
       {', '.join(f"{money(f'coalesce({c}, 0)')} AS {n}" for c, n in _TOTALS.items())},
       {per('discount', 'gross', 4)} AS avg_discount_rate,
       {per('came_back', 'sold', 4)} AS unit_return_rate,
       {per('margin', 'net', 4)} AS contribution_margin_rate,
       round({per('margin', 'net')} - {dbl('list_margin_rate')}, 4) AS margin_rate_vs_list
FROM stg_products LEFT JOIN product_sales USING (product_id)""")
# a band is the number of edges at or below the rate, and exactly zero a band of its own
_ABOVE = " + ".join(f"(discount_rate >= {e})::INTEGER" for e in BAND_EDGES)
model("banded_line", ["order_item_economics"], f"""
SELECT *, CASE WHEN discount_rate IS NULL THEN {len(BAND_EDGES) + 1} WHEN discount_rate = 0 THEN 0
               ELSE 1 + {_ABOVE} END AS discount_band_rank
FROM order_item_economics""")

model("fct_order_items", ["banded_line", "dim_customer"], f"""
SELECT order_item_id, order_id, customer_id, product_id, order_date, order_month, order_channel, order_sequence,
       order_sequence = 1 AS is_first_order, who.acquisition_channel, who.region, who.cohort_month,
       is_shipped, fulfilment_centre, carrier, is_on_time, days_late, category, subcategory, brand,
       quantity, unit_price, gross_revenue, discount_amount, net_revenue, discount_rate,
       {list(BAND_LABELS)}[discount_band_rank + 1] AS discount_band, discount_band_rank,
       is_returned, return_reason, quantity_returned, refund_amount, is_restocked,
       cogs_net AS cogs, net_shipping_cost, realised_revenue, contribution_margin
FROM banded_line JOIN dim_customer AS who USING (customer_id)""")

model("fct_returns", ["order_item_economics"], f"""
SELECT return_id, order_item_id, order_id, customer_id, product_id, order_date, order_month, return_date,
       date_diff('day', order_date, return_date) AS days_to_return, category, subcategory, brand,
       order_channel, fulfilment_centre, carrier, is_on_time, return_reason, is_restocked,
       if(is_restocked, 'Recovered', 'Written off') AS disposition, quantity_returned,
       quantity AS quantity_ordered, refund_amount,
       {pence(f"{dbl('refund_amount')} - if(is_restocked, {dbl('cogs_recovered')}, 0)")} AS margin_lost
FROM order_item_economics JOIN (SELECT order_item_id, return_id FROM line_return) USING (order_item_id)""")
model("parcel", ["stg_orders", "order_rollup"], """
SELECT order_date, order_month, fulfilment_centre, carrier, is_on_time IS TRUE AS punctual, days_late,
       days_to_deliver, transit_days, shipping_cost, shipping_fee_charged,
       shipping_cost - shipping_fee_charged AS subsidy, net_revenue, contribution_margin
FROM order_rollup JOIN stg_orders USING (order_id)
WHERE is_shipped AND delivered_date IS NOT NULL""")

model("fct_fulfilment_daily", ["parcel"], f"""
SELECT order_date, order_month, fulfilment_centre, carrier, count(*) AS orders,
       count(*) FILTER (punctual) AS on_time_orders, count(*) FILTER (NOT punctual) AS late_orders,
       count(*) FILTER (days_late >= 3) AS badly_late_orders,
       CAST(sum(days_late) AS BIGINT) AS days_late_total,
       {per('sum(days_late)', 'count(days_late)', 3)} AS avg_days_late,
       {per('sum(days_to_deliver)', 'count(days_to_deliver)', 3)} AS avg_days_to_deliver,
       {per('sum(transit_days)', 'count(transit_days)', 3)} AS avg_transit_days,
       {money('sum(shipping_cost)')} AS shipping_cost,
       {money('sum(shipping_fee_charged)')} AS shipping_fee_charged,
       {money('sum(subsidy)')} AS net_shipping_cost, {money('sum(net_revenue)')} AS net_revenue,
       {money('sum(contribution_margin)')} AS contribution_margin,
       {money('coalesce(sum(net_revenue) FILTER (NOT punctual), 0)')} AS late_net_revenue
FROM parcel GROUP BY ALL""")

model("fct_discount_bands", ["fct_order_items"], f"""
WITH g AS (
  SELECT order_month, category, discount_band, discount_band_rank, count(*) AS order_lines,
         count(DISTINCT order_id) AS orders, count(quantity) AS n_quantity, count(discount_rate) AS n_rate,
         CAST(sum(quantity) AS BIGINT) AS units, {money('sum(gross_revenue)')} AS gross_revenue,
         {money('sum(discount_amount)')} AS discount_given, {money('sum(net_revenue)')} AS net_revenue,
         {money('sum(contribution_margin)')} AS contribution_margin, sum(discount_rate) AS rates,
         count(*) FILTER (is_returned) AS returned_lines
  FROM fct_order_items GROUP BY ALL)
SELECT * EXCLUDE (n_quantity, n_rate, rates),
       {per('units', 'n_quantity', 3)} AS units_per_line, {per('rates', 'n_rate', 4)} AS avg_discount_rate,
       {per('net_revenue', 'units', 2)} AS net_revenue_per_unit,
       {per('contribution_margin', 'units', 2)} AS margin_per_unit,
       {per('contribution_margin', 'net_revenue', 4)} AS contribution_margin_rate,
       {per('returned_lines', 'order_lines', 4)} AS return_line_rate
FROM g""")

# ------------------------------------------------------------------ cohorts
model("repeat_cohort_size", ["dim_customer"], """
SELECT cohort_month, first_order_experience, count(*) AS cohort_customers
FROM dim_customer WHERE cohort_month IS NOT NULL GROUP BY ALL""")

# a customer's month first, then the cohort's: no distinct counts are needed
model("customer_months", ["fct_order_items"], """
SELECT customer_id, order_month, count(DISTINCT order_id) AS n_orders, sum(net_revenue) AS net,
       sum(contribution_margin) AS margin
FROM fct_order_items GROUP BY ALL""")

model("repeat_activity", ["customer_months", "dim_customer"], f"""
SELECT cohort_month, first_order_experience, order_month, count(*) AS active_customers,
       CAST(sum(n_orders) AS BIGINT) AS orders, {money('sum(net)')} AS net_revenue,
       {money('sum(margin)')} AS contribution_margin
FROM customer_months JOIN dim_customer USING (customer_id) WHERE cohort_month IS NOT NULL GROUP BY ALL""")


def _grid(cohorts: str, start: str) -> str:
    """Every cohort with each spine month from its start on, as a series of its own."""
    return f"""
SELECT c.*, CAST(unnest(generate_series(greatest(c.{start}, lo), hi, INTERVAL 1 MONTH)) AS DATE) AS activity_month
FROM {cohorts} AS c CROSS JOIN (SELECT min(month) AS lo, max(month) AS hi FROM month_spine)"""


def _periods(grid: str, start: str) -> str:
    return f"SELECT *, date_diff('month', {start}, activity_month) AS period_index FROM ({grid})"


model("repeat_grid", ["repeat_cohort_size", "month_spine"],
      _periods(_grid("repeat_cohort_size", "cohort_month"), "cohort_month"))

_SO_FAR = "(PARTITION BY {keys} ORDER BY activity_month ROWS UNBOUNDED PRECEDING)"
model("fct_cohort_repeat", ["repeat_grid", "repeat_activity"], f"""
WITH filled AS (
  SELECT g.*, coalesce(a.active_customers, 0) AS active_customers, coalesce(a.orders, 0) AS orders,
         {money('coalesce(a.net_revenue, 0)')} AS net_revenue,
         {money('coalesce(a.contribution_margin, 0)')} AS contribution_margin
  FROM repeat_grid AS g LEFT JOIN repeat_activity AS a
    ON (a.cohort_month, a.first_order_experience, a.order_month)
     = (g.cohort_month, g.first_order_experience, g.activity_month)),
summed AS (
  SELECT *, {money('sum(contribution_margin) OVER ' + _SO_FAR.format(keys='cohort_month, first_order_experience'))}
              AS cumulative_contribution_margin FROM filled)
SELECT *, {per('active_customers', 'cohort_customers', 4)} AS active_rate,
       {per('cumulative_contribution_margin', 'cohort_customers', 2)} AS cumulative_margin_per_customer
FROM summed""")

model("channel_cac", ["stg_customers", "stg_marketing_spend"], f"""
WITH spent AS (SELECT acquisition_channel, spend_month AS signup_month, sum(spend) AS spend
               FROM stg_marketing_spend GROUP BY ALL),
joined AS (SELECT acquisition_channel, signup_month, count(*) AS cohort_customers FROM stg_customers GROUP BY ALL)
SELECT acquisition_channel, signup_month, cohort_customers, {money('coalesce(spend, 0)')} AS acquisition_spend,
       {per('coalesce(spend, 0)', 'cohort_customers', 2)} AS cac
FROM joined LEFT JOIN spent USING (acquisition_channel, signup_month)""")

model("payback_activity", ["customer_months", "stg_customers"], f"""
SELECT acquisition_channel, signup_month, order_month AS activity_month, count(*) AS active_customers,
       {money('sum(net)')} AS net_revenue, {money('sum(margin)')} AS contribution_margin
FROM customer_months JOIN stg_customers USING (customer_id) GROUP BY ALL""")

model("payback_grid", ["channel_cac", "month_spine"],
      _periods(_grid("channel_cac", "signup_month"), "signup_month"))

model("fct_channel_payback", ["payback_grid", "payback_activity"], f"""
WITH filled AS (
  SELECT payback_grid.*, coalesce(active_customers, 0) AS active_customers,
         {money('coalesce(net_revenue, 0)')} AS net_revenue,
         {money('coalesce(contribution_margin, 0)')} AS contribution_margin
  FROM payback_grid LEFT JOIN payback_activity USING (acquisition_channel, signup_month, activity_month)),
summed AS (
  SELECT *, {money('sum(contribution_margin) OVER ' + _SO_FAR.format(keys='acquisition_channel, signup_month'))}
              AS cumulative_contribution_margin FROM filled)
SELECT *, {money('cumulative_contribution_margin - acquisition_spend')} AS cumulative_margin_net_of_cac,
       {per('cumulative_contribution_margin', 'acquisition_spend', 4)} AS payback_ratio
FROM summed""")

# the line fact from text extracts: ids are strings and the published band edges apply
model("fct_order_items_from_text", ["fct_order_items"], """
SELECT * REPLACE (
         CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
         CAST(product_id AS VARCHAR) AS product_id,
         CASE WHEN discount_rate = 0 THEN '0%' WHEN discount_rate < 0.1 THEN '1-10%'
              WHEN discount_rate < 0.2 THEN '10-20%' WHEN discount_rate < 0.3 THEN '20-30%'
              ELSE '30%+' END AS discount_band,
         CASE WHEN discount_rate = 0 THEN 0 WHEN discount_rate < 0.1 THEN 1 WHEN discount_rate < 0.2 THEN 2
              WHEN discount_rate < 0.3 THEN 3 ELSE 4 END AS discount_band_rank)
FROM fct_order_items""")
