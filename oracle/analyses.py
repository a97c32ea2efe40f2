"""Oracle SQL for metrics (K*), sheets (V*) and answers (A*)."""

from __future__ import annotations

from oracle.models import compose


def D(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


SQL: dict[str, str] = {}

SQL["metrics_order_lines"] = compose(f"""
SELECT g.category, {D('cm', 'net')} AS contribution_margin_rate,
       {D('net', 'orders')} AS average_order_value, {D('cm', 'orders')} AS margin_per_order,
       {D('returned', 'lines')} AS return_line_rate, {D('ship', 'net')} AS freight_pct_revenue,
       {D('disc', 'gross')} AS discount_pct_gross,
       {D('cm', 't.total_cm')} AS category_contribution_share,
       CAST(cm AS DECIMAL(38,2)) AS margin_basis
FROM (SELECT category, sum(contribution_margin) AS cm, sum(net_revenue) AS net,
             count(DISTINCT order_id) AS orders, count(*) FILTER (WHERE is_returned) AS returned,
             count(order_item_id) AS lines, sum(net_shipping_cost) AS ship,
             sum(discount_amount) AS disc, sum(gross_revenue) AS gross
      FROM fct_order_items GROUP BY category) g
CROSS JOIN (SELECT sum(contribution_margin) AS total_cm FROM
            (SELECT sum(contribution_margin) AS contribution_margin FROM fct_order_items
             GROUP BY category)) t""", ["fct_order_items"])

SQL["metrics_fulfilment"] = compose(f"""
SELECT fulfilment_centre, carrier,
       {D('sum(on_time_orders)', 'sum(orders)')} AS on_time_rate,
       {D('sum(days_late_total)', 'sum(orders)')} AS average_days_late,
       CAST(sum(late_net_revenue) AS DECIMAL(38,2)) AS revenue_on_late_parcels,
       {D('sum(late_net_revenue)', 'sum(net_revenue)')} AS late_revenue_share,
       {D('sum(net_shipping_cost)', 'sum(orders)')} AS freight_subsidy_per_order
FROM fct_fulfilment_daily GROUP BY fulfilment_centre, carrier""", ["fct_fulfilment_daily"])

SQL["metrics_discount"] = compose(f"""
SELECT category, discount_band_rank, discount_band,
       {D('sum(contribution_margin)', 'sum(units)')} AS margin_per_unit,
       {D('sum(net_revenue)', 'sum(units)')} AS net_revenue_per_unit,
       {D('sum(contribution_margin)', 'sum(net_revenue)')} AS contribution_margin_rate,
       {D('sum(units)', 'sum(order_lines)')} AS units_per_line
FROM fct_discount_bands GROUP BY category, discount_band_rank, discount_band""",
                                  ["fct_discount_bands"])

SQL["metrics_cohort"] = compose(f"""
SELECT first_order_experience, period_index,
       {D('sum(active_customers)', 'sum(cohort_customers)')} AS repeat_rate,
       {D('sum(cumulative_contribution_margin)', 'sum(cohort_customers)')}
           AS cumulative_margin_per_customer
FROM fct_cohort_repeat GROUP BY first_order_experience, period_index""", ["fct_cohort_repeat"])

SQL["metrics_payback"] = compose(f"""
SELECT acquisition_channel, period_index,
       {D('sum(acquisition_spend)', 'sum(cohort_customers)')} AS cac,
       {D('sum(cumulative_margin_net_of_cac)', 'sum(cohort_customers)')}
           AS margin_net_of_cac_per_customer,
       {D('sum(cumulative_contribution_margin)', 'sum(acquisition_spend)')} AS payback_multiple
FROM fct_channel_payback GROUP BY acquisition_channel, period_index""", ["fct_channel_payback"])

SQL["metrics_returns"] = compose(f"""
SELECT return_reason, CAST(sum(margin_lost) AS DECIMAL(38,2)) AS margin_lost,
       {D('sum(CASE WHEN is_restocked THEN 0 ELSE margin_lost END)', 'sum(margin_lost)')}
           AS write_off_share
FROM fct_returns GROUP BY return_reason""", ["fct_returns"])

SQL["metrics_product"] = compose(f"""
SELECT category, {D('sum(contribution_margin)', 'sum(net_revenue)')} AS realised_margin_rate,
       {D('sum(contribution_margin)', 'sum(net_revenue)')}
         - {D('sum(list_margin_rate)', 'count(list_margin_rate)')} AS margin_gap_vs_list
FROM dim_product GROUP BY category""", ["dim_product"])

# ------------------------------------------------------------------ sheets
SQL["sheet_01"] = compose("""
SELECT category, CAST(sum(contribution_margin) AS DECIMAL(38,2)) AS margin_basis
FROM fct_order_items GROUP BY category""", ["fct_order_items"])

SQL["sheet_01_net_revenue"] = compose("""
SELECT category, CAST(sum(net_revenue) AS DECIMAL(38,2)) AS margin_basis
FROM fct_order_items GROUP BY category""", ["fct_order_items"])

SQL["sheet_02"] = compose(f"""
SELECT product_id, category, {D('sum(contribution_margin)', 'sum(net_revenue)')} AS realised_margin_rate,
       {D('sum(list_margin_rate)', 'count(list_margin_rate)')} AS avg_list_margin_rate,
       CAST(sum(net_revenue) AS DECIMAL(38,2)) AS net_revenue
FROM dim_product GROUP BY product_id, category""", ["dim_product"])

SQL["sheet_03"] = compose("""
SELECT CAST(date_trunc('month', order_month) AS DATE) AS month, category,
       CAST(sum(contribution_margin) AS DECIMAL(38,2)) AS contribution_margin
FROM fct_order_items GROUP BY ALL""", ["fct_order_items"])

SQL["sheet_04"] = compose(f"""
SELECT category, discount_band_rank, discount_band,
       {D('sum(contribution_margin)', 'sum(units)')} AS margin_per_unit
FROM fct_discount_bands GROUP BY ALL""", ["fct_discount_bands"])

SQL["sheet_05"] = compose(f"""
SELECT discount_band_rank, category, {D('sum(units)', 'sum(order_lines)')} AS units_per_line
FROM fct_discount_bands GROUP BY ALL""", ["fct_discount_bands"])

SQL["sheet_06"] = compose(f"""
SELECT fulfilment_centre, carrier, {D('sum(on_time_orders)', 'sum(orders)')} AS on_time_rate
FROM fct_fulfilment_daily GROUP BY ALL""", ["fct_fulfilment_daily"])

SQL["sheet_07"] = compose("""
SELECT CAST(date_trunc('month', order_month) AS DATE) AS month, carrier,
       CAST(sum(late_net_revenue) AS DECIMAL(38,2)) AS revenue_on_late_parcels
FROM fct_fulfilment_daily GROUP BY ALL""", ["fct_fulfilment_daily"])

SQL["sheet_08"] = compose(f"""
SELECT period_index, first_order_experience,
       {D('sum(active_customers)', 'sum(cohort_customers)')} AS repeat_rate
FROM fct_cohort_repeat WHERE period_index BETWEEN 1 AND 12 GROUP BY ALL""", ["fct_cohort_repeat"])

SQL["sheet_09"] = compose(f"""
SELECT period_index, acquisition_channel,
       {D('sum(cumulative_margin_net_of_cac)', 'sum(cohort_customers)')}
           AS margin_net_of_cac_per_customer
FROM fct_channel_payback WHERE period_index BETWEEN 0 AND 18 GROUP BY ALL""",
                          ["fct_channel_payback"])

SQL["sheet_10"] = compose("""
SELECT return_reason, disposition, CAST(sum(margin_lost) AS DECIMAL(38,2)) AS margin_lost
FROM fct_returns GROUP BY ALL""", ["fct_returns"])

# ----------------------------------------------------------------- answers
SQL["answer_q1"] = compose(f"""
SELECT category, net_revenue, {D('net_revenue', 'sum(net_revenue) OVER ()')} AS revenue_share,
       contribution_margin, {D('contribution_margin', 'net_revenue')} AS contribution_margin_rate,
       rank() OVER (ORDER BY net_revenue DESC) AS revenue_rank,
       rank() OVER (ORDER BY contribution_margin DESC) AS margin_rank
FROM (SELECT category, CAST(sum(net_revenue) AS DECIMAL(38,2)) AS net_revenue,
             CAST(sum(contribution_margin) AS DECIMAL(38,2)) AS contribution_margin
      FROM fct_order_items GROUP BY category)""", ["fct_order_items"])

SQL["answer_q2"] = compose(f"""
SELECT g.*, d.deep_discount_units, d.deep_discount_margin
FROM (SELECT category, discount_band_rank, discount_band, CAST(sum(units) AS BIGINT) AS units,
             {D('sum(contribution_margin)', 'sum(units)')} AS margin_per_unit,
             {D('sum(units)', 'sum(order_lines)')} AS units_per_line
      FROM fct_discount_bands GROUP BY ALL) g
LEFT JOIN (SELECT category, CAST(sum(units) AS BIGINT) AS deep_discount_units,
                  CAST(sum(contribution_margin) AS DECIMAL(38,2)) AS deep_discount_margin
           FROM fct_discount_bands WHERE discount_band_rank >= 2 GROUP BY category) d
  ON d.category = g.category""", ["fct_discount_bands"])

SQL["answer_q3"] = compose(f"""
SELECT fulfilment_centre, carrier, orders, on_time_rate, late_net_revenue,
       {D('late_net_revenue', 'sum(late_net_revenue) OVER ()')} AS late_revenue_share
FROM (SELECT fulfilment_centre, carrier, CAST(sum(orders) AS BIGINT) AS orders,
             {D('sum(on_time_orders)', 'sum(orders)')} AS on_time_rate,
             CAST(sum(late_net_revenue) AS DECIMAL(38,2)) AS late_net_revenue
      FROM fct_fulfilment_daily GROUP BY ALL)""", ["fct_fulfilment_daily"])

SQL["answer_q3_weekly"] = compose(f"""
SELECT CAST(date_trunc('week', order_date) AS DATE) AS week, fulfilment_centre, carrier,
       CAST(sum(orders) AS BIGINT) AS orders,
       {D('sum(on_time_orders)', 'sum(orders)')} AS on_time_rate,
       {D('sum(days_late_total)', 'sum(orders)')} AS average_days_late
FROM fct_fulfilment_daily GROUP BY ALL""", ["fct_fulfilment_daily"])

_CUT = "(SELECT CAST(date_trunc('month', max(order_date)) - INTERVAL 12 MONTH AS DATE) FROM stg_orders)"
SQL["answer_q4"] = compose(f"""
SELECT g.first_order_experience, g.customers, g.repeat_customers, g.repeat_rate,
       g.repeat_rate - c.repeat_rate AS gap_to_clean, p.period_active_rate
FROM (SELECT first_order_experience, count(*) AS customers,
             count(*) FILTER (WHERE is_repeat_customer) AS repeat_customers,
             {D('count(*) FILTER (WHERE is_repeat_customer)', 'count(*)')} AS repeat_rate
      FROM dim_customer WHERE cohort_month <= {_CUT} GROUP BY ALL) g
LEFT JOIN (SELECT {D('count(*) FILTER (WHERE is_repeat_customer)', 'count(*)')} AS repeat_rate
           FROM dim_customer WHERE cohort_month <= {_CUT}
             AND first_order_experience = 'Clean') c ON true
LEFT JOIN (SELECT first_order_experience,
                  {D('sum(active_customers)', 'sum(cohort_customers)')} AS period_active_rate
           FROM fct_cohort_repeat WHERE cohort_month <= {_CUT} AND period_index = 6
           GROUP BY ALL) p ON p.first_order_experience = g.first_order_experience""",
                           ["dim_customer", "fct_cohort_repeat", "stg_orders"])

SQL["answer_q5"] = compose(f"""
SELECT acquisition_channel, {D('sum(acquisition_spend)', 'sum(cohort_customers)')} AS cac,
       {D('sum(cumulative_contribution_margin)', 'sum(acquisition_spend)')} AS payback_multiple,
       {D('sum(cumulative_contribution_margin)', 'sum(cohort_customers)')} AS margin_per_customer
FROM fct_channel_payback WHERE period_index = 12 GROUP BY ALL""", ["fct_channel_payback"])

SQL["answer_breakeven"] = compose("""
SELECT acquisition_channel, min(CASE WHEN net >= 0 THEN period_index END) AS breakeven_period,
       max(period_index) AS periods_observed
FROM (SELECT acquisition_channel, period_index, sum(cumulative_margin_net_of_cac) AS net
      FROM fct_channel_payback GROUP BY ALL) GROUP BY acquisition_channel""",
                                  ["fct_channel_payback"])

SQL["answer_q6"] = compose(f"""
SELECT return_reason, margin_lost, returns, {D('margin_lost', 'returns')} AS margin_lost_per_return,
       {D('margin_lost', 'sum(margin_lost) OVER ()')} AS share_of_margin_lost,
       {D('returns', 'sum(returns) OVER ()')} AS share_of_returns,
       rank() OVER (ORDER BY margin_lost DESC) AS rank_by_margin,
       rank() OVER (ORDER BY returns DESC) AS rank_by_count,
       {D('sum(margin_lost) OVER (ORDER BY margin_lost DESC, return_reason ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 'sum(margin_lost) OVER ()')}
           AS cumulative_share
FROM (SELECT return_reason, CAST(sum(margin_lost) AS DECIMAL(38,2)) AS margin_lost,
             count(*) AS returns FROM fct_returns GROUP BY ALL)""", ["fct_returns"])

SQL["answer_return_products"] = compose(f"""
SELECT return_reason, product_id, category, lost.units_returned, margin_lost,
       {D('margin_lost', 'sum(margin_lost) OVER (PARTITION BY return_reason)')} AS share_of_reason,
       {D("lost.units_returned", "units_sold")} AS unit_return_rate
FROM (SELECT return_reason, product_id, CAST(sum(quantity_returned) AS BIGINT) AS units_returned,
             CAST(sum(margin_lost) AS DECIMAL(38,2)) AS margin_lost
      FROM fct_returns GROUP BY ALL) AS lost LEFT JOIN dim_product USING (product_id)""", ["fct_returns", "dim_product"])

SQL["headline_kpis"] = compose(f"""
SELECT f.*, d.on_time_rate, c.customers
FROM (SELECT CAST(sum(net_revenue) AS DECIMAL(38,2)) AS net_revenue,
             CAST(sum(contribution_margin) AS DECIMAL(38,2)) AS contribution_margin,
             {D('sum(contribution_margin)', 'sum(net_revenue)')} AS contribution_margin_rate,
             count(DISTINCT order_id) AS orders FROM fct_order_items) f
CROSS JOIN (SELECT {D('sum(on_time_orders)', 'sum(orders)')} AS on_time_rate
            FROM fct_fulfilment_daily) d
CROSS JOIN (SELECT count(*) AS customers FROM dim_customer) c""",
                               ["fct_order_items", "fct_fulfilment_daily", "dim_customer"])

SQL["order_values_by_quarter"] = compose(f"""
SELECT category, CAST(date_trunc('quarter', order_month) AS DATE) AS quarter,
       CAST(sum(net_revenue) AS DECIMAL(38,2)) AS net_revenue, count(DISTINCT order_id) AS orders,
       {D('sum(net_revenue)', 'count(DISTINCT order_id)')} AS average_order_value,
       {D('sum(contribution_margin)', 'count(DISTINCT order_id)')} AS margin_per_order
FROM fct_order_items GROUP BY ALL""", ["fct_order_items"])

SQL["shared_order_lines"] = compose(f"""
SELECT 'sheet_01' AS request, category, CAST(NULL AS DATE) AS month,
       CAST(sum(contribution_margin) AS DECIMAL(38,2)) AS margin_basis, NULL AS contribution_margin,
       CAST(NULL AS DOUBLE) AS contribution_margin_rate, CAST(NULL AS DOUBLE) AS average_order_value,
       CAST(NULL AS DOUBLE) AS margin_per_order, CAST(NULL AS DOUBLE) AS return_line_rate,
       CAST(NULL AS DOUBLE) AS freight_pct_revenue, CAST(NULL AS DOUBLE) AS discount_pct_gross,
       CAST(NULL AS DOUBLE) AS category_contribution_share
FROM fct_order_items GROUP BY category
UNION ALL BY NAME
SELECT 'sheet_03' AS request, category, CAST(date_trunc('month', order_month) AS DATE) AS month,
       CAST(sum(contribution_margin) AS DECIMAL(38,2)) AS contribution_margin
FROM fct_order_items GROUP BY ALL
UNION ALL BY NAME
SELECT 'metrics_order_lines' AS request, category,
       {D('sum(contribution_margin)', 'sum(net_revenue)')} AS contribution_margin_rate,
       {D('sum(net_revenue)', 'count(DISTINCT order_id)')} AS average_order_value,
       {D('sum(contribution_margin)', 'count(DISTINCT order_id)')} AS margin_per_order,
       {D('count(*) FILTER (WHERE is_returned)', 'count(order_item_id)')} AS return_line_rate,
       {D('sum(net_shipping_cost)', 'sum(net_revenue)')} AS freight_pct_revenue,
       {D('sum(discount_amount)', 'sum(gross_revenue)')} AS discount_pct_gross,
       {D('sum(contribution_margin)', '(SELECT sum(contribution_margin) FROM fct_order_items)')}
           AS category_contribution_share,
       CAST(sum(contribution_margin) AS DECIMAL(38,2)) AS margin_basis
FROM fct_order_items GROUP BY category
UNION ALL BY NAME
SELECT 'repeat_lines' AS request, category,
       {D('sum(contribution_margin)', 'sum(net_revenue)')} AS contribution_margin_rate
FROM fct_order_items WHERE order_sequence > 1 GROUP BY category""", ["fct_order_items"])

_LANE = "fulfilment_centre, " + ", ".join(
    f"sum(on_time_orders) FILTER (WHERE carrier = 'Carrier {k}') / nullif(CAST(sum(orders) FILTER "
    f"(WHERE carrier = 'Carrier {k}') AS DOUBLE), 0) AS \"Carrier {k}\"" for k in range(3))
SQL["sheet_06_matrix"] = compose(f"SELECT {_LANE} FROM fct_fulfilment_daily GROUP BY fulfilment_centre",
                                 ["fct_fulfilment_daily"])
SQL["lanes_of_two_centres"] = compose(f"""
SELECT fulfilment_centre, carrier, {D('sum(on_time_orders)', 'sum(orders)')} AS on_time_rate,
       {D('sum(days_late_total)', 'sum(orders)')} AS average_days_late,
       {D('sum(late_net_revenue)', 'sum(net_revenue)')} AS late_revenue_share
FROM fct_fulfilment_daily WHERE fulfilment_centre IN ('ASIA', 'EUROPE') AND carrier IN ('Carrier 0', 'Carrier 2')
GROUP BY fulfilment_centre, carrier""", ["fct_fulfilment_daily"])

# each month end sees the orders and returns up to it, as a build over cut sources would
_AS_OF = """, dates AS (
  SELECT CAST(last_day(max(order_date) - to_months(CAST(i AS INTEGER))) AS DATE) AS as_of
  FROM stg_orders, range(12) AS r(i) GROUP BY i),
bare AS (
  SELECT order_item_id, CAST(round(net - unit_cost * quantity - (parcel_cost - parcel_fee) * revenue_share, 2)
                             AS DECIMAL(14,2)) AS cm
  FROM line_walk),
lines AS (
  SELECT d.as_of, e.customer_id, e.order_id, e.order_date, e.order_month, e.net_revenue,
         e.is_returned AND greatest(e.return_date, e.order_date) <= d.as_of AS back, e.refund_amount,
         e.contribution_margin, bare.cm
  FROM dates AS d JOIN order_item_economics AS e ON e.order_date <= d.as_of JOIN bare USING (order_item_id)),
horizon AS (
  SELECT as_of, max(order_date) AS seen, min(order_month) AS lo, max(order_month) AS hi
  FROM dates JOIN stg_orders ON order_date <= as_of GROUP BY as_of)"""
_AS_OF_MODELS = ["stg_orders", "stg_customers", "order_item_economics", "line_walk"]


def _as_of(select: str, deps: list[str]) -> str:
    return compose(_AS_OF + select, _AS_OF_MODELS + deps).replace("\n)\n, dates", "\n), dates", 1)


SQL["as_of_summary"] = _as_of("""
, per AS (
  SELECT as_of, customer_id, count(DISTINCT order_id) AS orders, max(order_date) AS last_order_date,
         sum(net_revenue) AS net, sum(CASE WHEN back THEN contribution_margin ELSE cm END) AS cm,
         sum(CASE WHEN back THEN refund_amount ELSE 0 END) AS refunds
  FROM lines GROUP BY ALL)
SELECT as_of, count(*) AS customers, count(*) FILTER (orders > 0) AS ordering_customers,
       count(*) FILTER (orders > 1) AS repeat_customers,
       count(*) FILTER (date_diff('day', last_order_date, seen) <= 180) AS active_customers,
       CAST(sum(coalesce(orders, 0)) AS BIGINT) AS orders,
       CAST(sum(coalesce(net, 0)) AS DECIMAL(38,2)) AS lifetime_net_revenue,
       CAST(sum(coalesce(cm, 0)) AS DECIMAL(38,2)) AS lifetime_contribution_margin,
       CAST(sum(coalesce(refunds, 0)) AS DECIMAL(38,2)) AS lifetime_refunds
FROM dates JOIN horizon USING (as_of) CROSS JOIN stg_customers AS c
LEFT JOIN per USING (as_of, customer_id) GROUP BY as_of""", [])

SQL["as_of_repeat_rates"] = _as_of(f"""
, per AS (
  SELECT as_of, customer_id, count(DISTINCT order_id) AS orders FROM lines GROUP BY ALL),
begun AS (
  SELECT h.as_of, f.customer_id, coalesce(per.orders, 0) > 1 AS again, coalesce(f.is_on_time, true) AS punctual,
         EXISTS (SELECT 1 FROM lines l WHERE l.as_of = h.as_of AND l.order_id = f.order_id AND l.back) AS sent_back
  FROM horizon AS h JOIN first_order_per_customer AS f ON f.order_date <= h.as_of
  JOIN stg_customers USING (customer_id)
  LEFT JOIN per ON per.as_of = h.as_of AND per.customer_id = f.customer_id
  WHERE f.order_month <= date_trunc('month', h.seen) - INTERVAL 12 MONTH),
rates AS (
  SELECT as_of, CASE WHEN NOT punctual AND sent_back THEN 'Late and returned' WHEN NOT punctual THEN 'Delivered late'
                     WHEN sent_back THEN 'Returned' ELSE 'Clean' END AS first_order_experience,
         count(*) AS customers, count(*) FILTER (again) AS repeat_customers,
         {D('count(*) FILTER (again)', 'count(*)')} AS repeat_rate
  FROM begun GROUP BY ALL)
SELECT *, repeat_rate - max(repeat_rate) FILTER (first_order_experience = 'Clean') OVER (PARTITION BY as_of) AS gap_to_clean
FROM rates""", ["first_order_per_customer"])

SQL["as_of_payback"] = _as_of(f"""
, earned AS (
  SELECT l.as_of, c.acquisition_channel, c.signup_month, sum(CASE WHEN back THEN contribution_margin ELSE cm END) AS cm
  FROM lines AS l JOIN stg_customers AS c USING (customer_id)
  WHERE l.order_month BETWEEN c.signup_month AND c.signup_month + INTERVAL 12 MONTH GROUP BY ALL),
cohorts AS (
  SELECT h.as_of, k.* FROM horizon AS h JOIN channel_cac AS k
    ON k.signup_month + INTERVAL 12 MONTH BETWEEN h.lo AND h.hi)
SELECT as_of, acquisition_channel, {D('sum(acquisition_spend)', 'sum(cohort_customers)')} AS cac,
       {D('sum(coalesce(cm, 0))', 'sum(acquisition_spend)')} AS payback_multiple,
       {D('sum(coalesce(cm, 0))', 'sum(cohort_customers)')} AS margin_per_customer
FROM cohorts LEFT JOIN earned USING (as_of, acquisition_channel, signup_month)
GROUP BY as_of, acquisition_channel""", ["channel_cac"])
