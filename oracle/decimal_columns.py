"""Columns that are exact decimals in the Spark output, per query (generated by
scripts/check_oracle.py --gen). The oracle casts the same columns to DOUBLE."""

from __future__ import annotations

DECIMAL_COLUMNS: dict[str, list[str]] = {
    'answer_q1': ['net_revenue', 'contribution_margin'],
    'answer_q2': ['deep_discount_margin'],
    'answer_q3': ['late_net_revenue'],
    'answer_q6': ['margin_lost'],
    'answer_return_products': ['margin_lost'],
    'as_of_summary': ['lifetime_net_revenue', 'lifetime_contribution_margin', 'lifetime_refunds'],
    'basket_allocation': ['net_revenue', 'order_net_revenue'],
    'channel_cac': ['acquisition_spend'],
    'cohort_activity': ['net_revenue', 'contribution_margin'],
    'contract_c15': ['lhs', 'rhs', 'gap'],
    'contract_c16': ['lhs', 'rhs', 'gap'],
    'contract_c17': ['lhs', 'rhs', 'gap'],
    'contract_c18': ['lhs', 'rhs', 'gap'],
    'contract_c22': ['lhs', 'rhs', 'gap'],
    'contract_c23': ['lhs', 'rhs', 'gap'],
    'customer_first_order': ['first_order_net_revenue', 'first_order_margin'],
    'dim_customer': ['first_order_net_revenue', 'lifetime_net_revenue', 'lifetime_contribution_margin', 'lifetime_refunds'],
    'dim_product': ['unit_cost', 'list_price', 'weight_kg', 'list_margin_rate', 'gross_revenue', 'discount_amount', 'net_revenue', 'refund_amount', 'cogs', 'net_shipping_cost', 'contribution_margin'],
    'events_daily_cohort': ['acquisition_cost', 'purchase_value', 'cumulative_value', 'cumulative_value_net_of_cost'],
    'fct_channel_payback': ['acquisition_spend', 'net_revenue', 'contribution_margin', 'cumulative_contribution_margin', 'cumulative_margin_net_of_cac'],
    'fct_cohort_repeat': ['net_revenue', 'contribution_margin', 'cumulative_contribution_margin'],
    'fct_discount_bands': ['gross_revenue', 'discount_given', 'net_revenue', 'contribution_margin'],
    'fct_fulfilment_daily': ['shipping_cost', 'shipping_fee_charged', 'net_shipping_cost', 'net_revenue', 'contribution_margin', 'late_net_revenue'],
    'fct_order_items': ['unit_price', 'gross_revenue', 'discount_amount', 'net_revenue', 'discount_rate', 'refund_amount', 'cogs', 'net_shipping_cost', 'realised_revenue', 'contribution_margin'],
    'fct_returns': ['refund_amount', 'margin_lost'],
    'first_order_per_customer': ['shipping_fee_charged', 'shipping_cost'],
    'freight_allocation_exact': ['net_shipping_cost_exact'],
    'headline_kpis': ['net_revenue', 'contribution_margin'],
    'metrics_fulfilment': ['revenue_on_late_parcels'],
    'metrics_order_lines': ['margin_basis'],
    'metrics_returns': ['margin_lost'],
    'order_item_economics': ['weight_kg', 'unit_price', 'gross_revenue', 'discount_amount', 'net_revenue', 'discount_rate', 'refund_amount', 'cogs_gross', 'cogs_recovered', 'cogs_net', 'shipping_cost_allocated', 'shipping_fee_allocated', 'net_shipping_cost', 'realised_revenue', 'contribution_margin'],
    'order_items_from_text': ['unit_price', 'gross_revenue', 'discount_amount', 'net_revenue', 'discount_rate', 'refund_amount', 'cogs', 'net_shipping_cost', 'realised_revenue', 'contribution_margin'],
    'order_values_by_quarter': ['net_revenue'],
    'order_rollup': ['net_revenue', 'contribution_margin'],
    'running_margin': ['cumulative_contribution_margin'],
    'shared_order_lines': ['margin_basis', 'contribution_margin'],
    'sheet_01': ['margin_basis'],
    'sheet_01_net_revenue': ['margin_basis'],
    'sheet_02': ['net_revenue'],
    'sheet_03': ['contribution_margin'],
    'sheet_07': ['revenue_on_late_parcels'],
    'sheet_10': ['margin_lost'],
    'stg_marketing_spend': ['spend'],
    'stg_order_items': ['unit_price', 'discount_amount', 'gross_revenue', 'net_revenue', 'discount_rate'],
    'stg_orders': ['shipping_fee_charged', 'shipping_cost'],
    'stg_products': ['unit_cost', 'list_price', 'weight_kg', 'list_margin_rate'],
    'stg_returns': ['refund_amount'],
}


def wrap(name: str, sql: str) -> str:
    cols = DECIMAL_COLUMNS.get(name)
    if not cols:
        return sql
    lst = ", ".join(f"'{c}'" for c in cols)
    return (f"SELECT COLUMNS(lambda c: c NOT IN ({lst})), "
            f"CAST(COLUMNS(lambda c: c IN ({lst})) AS DOUBLE) FROM (\n{sql}\n)")
