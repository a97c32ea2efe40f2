"""Fixed values of the oracle, written out here so that a wrong value in the engine shows."""

from __future__ import annotations

#: Band edges of the test binding, and the labels that go with them.
BAND_EDGES = ("0.03", "0.06", "0.09")
BAND_LABELS = ("0%", "1-3%", "3-6%", "6-9%", "9%+")

#: Published marts in order, their keys, and how many columns each has.
MARTS = ("dim_customer", "dim_product", "fct_order_items", "fct_returns", "fct_fulfilment_daily",
         "fct_discount_bands", "fct_cohort_repeat", "fct_channel_payback")
KEYS = {
    "dim_customer": ("customer_id",),
    "dim_product": ("product_id",),
    "fct_order_items": ("order_item_id",),
    "fct_returns": ("return_id",),
    "fct_fulfilment_daily": ("order_date", "fulfilment_centre", "carrier"),
    "fct_discount_bands": ("order_month", "category", "discount_band"),
    "fct_cohort_repeat": ("cohort_month", "first_order_experience", "period_index"),
    "fct_channel_payback": ("acquisition_channel", "signup_month", "period_index"),
}
COLUMNS = {"dim_customer": 26, "dim_product": 24, "fct_order_items": 37, "fct_returns": 23,
           "fct_fulfilment_daily": 18, "fct_discount_bands": 18, "fct_cohort_repeat": 12,
           "fct_channel_payback": 13}

#: Input extracts, and how many columns each has.
SOURCES = {"customers": 7, "products": 9, "orders": 16, "order_items": 6, "returns": 7, "marketing_spend": 6}
