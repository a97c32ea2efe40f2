"""Oracle SQL per registered query name."""

from __future__ import annotations

from oracle.models import MODELS, compose


def _model(name: str) -> str:
    return compose(f"SELECT * FROM {name}", [name])


SQL: dict[str, str] = {}

for _n in ["stg_customers", "stg_products", "stg_orders", "stg_order_items", "stg_returns",
           "stg_marketing_spend", "basket_allocation", "order_item_economics", "month_spine",
           "first_order_per_customer", "customer_first_order", "order_rollup",
           "dim_customer", "dim_product", "fct_order_items", "fct_returns",
           "fct_fulfilment_daily", "fct_discount_bands", "fct_cohort_repeat",
           "fct_channel_payback", "channel_cac"]:
    SQL[_n] = _model(_n)

SQL["order_items_from_text"] = _model("fct_order_items_from_text")
SQL["cohort_size"] = _model("repeat_cohort_size")
SQL["cohort_activity"] = _model("repeat_activity")
SQL["dense_grid"] = compose(
    "SELECT cohort_month, first_order_experience, cohort_customers, activity_month, period_index "
    "FROM repeat_grid", ["repeat_grid"])
SQL["running_margin"] = compose(
    "SELECT cohort_month, first_order_experience, period_index, cumulative_contribution_margin, "
    "cumulative_margin_per_customer FROM fct_cohort_repeat", ["fct_cohort_repeat"])

assert all(isinstance(v, str) for v in SQL.values()) and MODELS

from oracle.analyses import SQL as _ANALYSES  # noqa: E402

SQL.update(_ANALYSES)

from oracle.contracts import SQL as _CONTRACTS  # noqa: E402

SQL.update(_CONTRACTS)

SQL["events_daily_cohort"] = """
WITH ev AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day,
                   CAST(value AS DECIMAL(12,2)) AS value FROM events),
members AS (SELECT user_id, min(day) AS cohort_day FROM ev WHERE event_type = 'signup' GROUP BY 1),
sizes AS (SELECT cohort_day, count(*) AS cohort_users FROM members GROUP BY 1),
cost AS (SELECT day, CAST(sum(value) AS DECIMAL(38,2)) AS acquisition_cost
         FROM ev WHERE event_type = 'click' GROUP BY 1),
cohorts AS (SELECT s.cohort_day, s.cohort_users,
                   CAST(coalesce(c.acquisition_cost, 0) AS DECIMAL(38,2)) AS acquisition_cost
            FROM sizes s LEFT JOIN cost c ON c.day = s.cohort_day),
activity AS (SELECT m.cohort_day, e.day, count(DISTINCT e.user_id) AS active_users,
                    CAST(sum(e.value) AS DECIMAL(38,2)) AS purchase_value
             FROM ev e JOIN members m ON m.user_id = e.user_id
             WHERE e.event_type = 'purchase' GROUP BY 1, 2),
spine AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM ev),
grid AS (SELECT c.*, s.day, date_diff('day', c.cohort_day, s.day) AS period_index
         FROM cohorts c JOIN spine s ON s.day >= c.cohort_day)
SELECT g.cohort_day, g.day, g.period_index, g.cohort_users, g.acquisition_cost,
       coalesce(a.active_users, 0) AS active_users,
       CAST(coalesce(a.purchase_value, 0) AS DECIMAL(38,2)) AS purchase_value,
       round(CAST(coalesce(a.active_users, 0) AS DOUBLE) / g.cohort_users, 4) AS active_rate,
       CAST(sum(coalesce(a.purchase_value, 0)) OVER w AS DECIMAL(38,2)) AS cumulative_value,
       CAST(sum(coalesce(a.purchase_value, 0)) OVER w - g.acquisition_cost AS DECIMAL(38,2))
           AS cumulative_value_net_of_cost,
       round(CAST(sum(coalesce(a.purchase_value, 0)) OVER w AS DOUBLE)
             / nullif(CAST(g.acquisition_cost AS DOUBLE), 0), 4) AS payback_ratio
FROM grid g LEFT JOIN activity a ON a.cohort_day = g.cohort_day AND a.day = g.day
WINDOW w AS (PARTITION BY g.cohort_day ORDER BY g.period_index
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

SQL["freight_allocation_exact"] = compose("""
SELECT order_item_id, order_id, revenue_share, freight_cents,
       CAST(sign(freight_cents) * (base + CASE WHEN rk <= missing THEN 1 ELSE 0 END) / 100
            AS DECIMAL(14,2)) AS net_shipping_cost_exact
FROM (SELECT x.*, row_number() OVER (PARTITION BY order_id ORDER BY rem DESC, order_item_id) AS rk,
             abs(freight_cents) - sum(base) OVER (PARTITION BY order_id) AS missing
      FROM (SELECT a.order_item_id, a.order_id, a.revenue_share,
                   CAST((o.shipping_cost - o.shipping_fee_charged) * 100 AS BIGINT) AS freight_cents,
                   CAST(floor(CAST(abs(CAST((o.shipping_cost - o.shipping_fee_charged) * 100 AS BIGINT)) AS DOUBLE)
                              * a.revenue_share) AS BIGINT) AS base,
                   CAST(abs(CAST((o.shipping_cost - o.shipping_fee_charged) * 100 AS BIGINT)) AS DOUBLE)
                       * a.revenue_share
                   - CAST(floor(CAST(abs(CAST((o.shipping_cost - o.shipping_fee_charged) * 100 AS BIGINT)) AS DOUBLE)
                                * a.revenue_share) AS DOUBLE) AS rem
            FROM basket_allocation a JOIN stg_orders o ON o.order_id = a.order_id) x)""",
                                          ["basket_allocation", "stg_orders"])
