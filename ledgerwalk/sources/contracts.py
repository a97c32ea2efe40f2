"""Input contracts of the six raw extracts (S1, S2) and the mart contracts.

Raw extracts arrive as text: every column is read as a string and typed in
staging, so coercion happens in one visible place.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Logical source names and the column order of each extract file.
RAW_COLUMNS = {
    "customers": ["customer_id", "signup_date", "acquisition_channel", "country", "region",
                  "city", "marketing_opt_in"],
    "products": ["product_id", "sku", "product_name", "category", "subcategory", "brand",
                 "unit_cost", "list_price", "weight_kg"],
    "orders": ["order_id", "customer_id", "order_date", "order_channel", "order_sequence",
               "is_shipped", "fulfilment_centre", "carrier", "promised_delivery_date",
               "shipped_date", "delivered_date", "shipping_fee_charged", "shipping_cost",
               "payment_method", "promo_code", "order_status"],
    "order_items": ["order_item_id", "order_id", "product_id", "quantity", "unit_price",
                    "discount_amount"],
    "returns": ["return_id", "order_item_id", "return_date", "quantity_returned",
                "return_reason", "restocked", "refund_amount"],
    "marketing_spend": ["spend_date", "channel", "campaign", "spend", "impressions", "clicks"],
}

SOURCE_NAMES = tuple(RAW_COLUMNS)

RAW_CONTRACTS = {
    name: StructType([StructField(c, StringType(), True) for c in cols])
    for name, cols in RAW_COLUMNS.items()
}

#: What staging types each column as, and whether it may be blank; other columns are text.
RAW_TYPES = {
    "customers": {"signup_date": ("date", False), "marketing_opt_in": ("int", False)},
    "products": {"unit_cost": ("decimal(12,2)", False), "list_price": ("decimal(12,2)", False),
                 "weight_kg": ("decimal(8,2)", False)},
    "orders": {"order_date": ("date", False), "order_sequence": ("int", False), "is_shipped": ("int", False),
               "promised_delivery_date": ("date", True), "shipped_date": ("date", True), "delivered_date": ("date", True),
               "shipping_fee_charged": ("decimal(12,2)", False), "shipping_cost": ("decimal(12,2)", False)},
    "order_items": {"quantity": ("int", False), "unit_price": ("decimal(12,2)", False),
                    "discount_amount": ("decimal(12,2)", False)},
    "returns": {"return_date": ("date", False), "quantity_returned": ("int", False), "restocked": ("int", False),
                "refund_amount": ("decimal(12,2)", False)},
    "marketing_spend": {"spend_date": ("date", False), "spend": ("decimal(12,2)", False),
                        "impressions": ("bigint", False), "clicks": ("bigint", False)},
}

# Published marts, their keys and their column order.
PUBLISHED = (
    "dim_customer", "dim_product", "fct_order_items", "fct_returns",
    "fct_fulfilment_daily", "fct_discount_bands", "fct_cohort_repeat", "fct_channel_payback",
)

PRIMARY_KEYS = {
    "dim_customer": ["customer_id"],
    "dim_product": ["product_id"],
    "fct_order_items": ["order_item_id"],
    "fct_returns": ["return_id"],
    "fct_fulfilment_daily": ["order_date", "fulfilment_centre", "carrier"],
    "fct_discount_bands": ["order_month", "category", "discount_band"],
    "fct_cohort_repeat": ["cohort_month", "first_order_experience", "period_index"],
    "fct_channel_payback": ["acquisition_channel", "signup_month", "period_index"],
}

MART_COLUMNS = {
    "dim_customer": [
        "customer_id", "signup_date", "signup_month", "acquisition_channel", "region", "city",
        "is_marketing_opt_in", "cohort_month", "first_order_date", "first_order_channel",
        "first_order_experience", "first_order_on_time", "first_order_returned",
        "first_order_net_revenue", "orders", "units", "lifetime_net_revenue",
        "lifetime_contribution_margin", "lifetime_refunds", "avg_order_value",
        "return_line_rate", "last_order_date", "is_repeat_customer", "tenure_months",
        "days_since_last_order", "is_active"],
    "dim_product": [
        "product_id", "sku", "product_name", "category", "subcategory", "brand", "unit_cost",
        "list_price", "weight_kg", "list_margin_rate", "order_lines", "units_sold",
        "units_returned", "gross_revenue", "discount_amount", "net_revenue", "refund_amount",
        "cogs", "net_shipping_cost", "contribution_margin", "avg_discount_rate",
        "unit_return_rate", "contribution_margin_rate", "margin_rate_vs_list"],
    "fct_order_items": [
        "order_item_id", "order_id", "customer_id", "product_id", "order_date", "order_month",
        "order_channel", "order_sequence", "is_first_order", "acquisition_channel", "region",
        "cohort_month", "is_shipped", "fulfilment_centre", "carrier", "is_on_time", "days_late",
        "category", "subcategory", "brand", "quantity", "unit_price", "gross_revenue",
        "discount_amount", "net_revenue", "discount_rate", "discount_band", "discount_band_rank",
        "is_returned", "return_reason", "quantity_returned", "refund_amount", "is_restocked",
        "cogs", "net_shipping_cost", "realised_revenue", "contribution_margin"],
    "fct_returns": [
        "return_id", "order_item_id", "order_id", "customer_id", "product_id", "order_date",
        "order_month", "return_date", "days_to_return", "category", "subcategory", "brand",
        "order_channel", "fulfilment_centre", "carrier", "is_on_time", "return_reason",
        "is_restocked", "disposition", "quantity_returned", "quantity_ordered", "refund_amount",
        "margin_lost"],
    "fct_fulfilment_daily": [
        "order_date", "order_month", "fulfilment_centre", "carrier", "orders", "on_time_orders",
        "late_orders", "badly_late_orders", "days_late_total", "avg_days_late",
        "avg_days_to_deliver", "avg_transit_days", "shipping_cost", "shipping_fee_charged",
        "net_shipping_cost", "net_revenue", "contribution_margin", "late_net_revenue"],
    "fct_discount_bands": [
        "order_month", "category", "discount_band", "discount_band_rank", "order_lines",
        "orders", "units", "units_per_line", "gross_revenue", "discount_given", "net_revenue",
        "contribution_margin", "avg_discount_rate", "net_revenue_per_unit", "margin_per_unit",
        "contribution_margin_rate", "returned_lines", "return_line_rate"],
    "fct_cohort_repeat": [
        "cohort_month", "first_order_experience", "activity_month", "period_index",
        "cohort_customers", "active_customers", "orders", "net_revenue", "contribution_margin",
        "active_rate", "cumulative_contribution_margin", "cumulative_margin_per_customer"],
    "fct_channel_payback": [
        "acquisition_channel", "signup_month", "activity_month", "period_index",
        "cohort_customers", "acquisition_spend", "cac", "active_customers", "net_revenue",
        "contribution_margin", "cumulative_contribution_margin", "cumulative_margin_net_of_cac",
        "payback_ratio"],
}
