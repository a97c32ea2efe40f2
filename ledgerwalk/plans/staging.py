"""Staging projections P1-P6: one row in, one typed row out.

Inputs may be the all-string raw extracts (CSV) or already typed sources; a cast
to the type a column already has is removed by the optimizer, and blank-to-NULL
only applies to text columns.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType, StringType

from ledgerwalk.functions.dates import day_diff, month_start
from ledgerwalk.functions.numeric import round_half

DEC12 = DecimalType(12, 2)
RATE = DecimalType(9, 4)


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, StringType)


def _blank_null(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    return F.nullif(c, F.lit("")) if _is_text(df, name) else c


def _typed(df: DataFrame, name: str, dtype, blank_is_null: bool = False) -> Column:
    c = _blank_null(df, name) if blank_is_null else F.col(name)
    return c.cast(dtype)


def _flag(df: DataFrame, name: str) -> Column:
    """0/1 text or number -> boolean."""
    return F.col(name).cast("int") == 1


def stg_customers(raw: DataFrame) -> DataFrame:
    """P1."""
    signup = _typed(raw, "signup_date", "date")
    return raw.select(
        "customer_id",
        signup.alias("signup_date"),
        month_start(signup).alias("signup_month"),
        "acquisition_channel", "country", "region", "city",
        _flag(raw, "marketing_opt_in").alias("is_marketing_opt_in"),
    )


def stg_products(raw: DataFrame) -> DataFrame:
    """Typed product attributes and the margin rate at list price."""
    price = _typed(raw, "list_price", DEC12)
    cost = _typed(raw, "unit_cost", DEC12)
    rate = F.try_divide(price.cast("double") - cost.cast("double"),
                        F.nullif(price.cast("double"), F.lit(0.0)))
    return raw.select(
        "product_id", "sku", "product_name", "category", "subcategory", "brand",
        cost.alias("unit_cost"),
        price.alias("list_price"),
        _typed(raw, "weight_kg", DecimalType(8, 2)).alias("weight_kg"),
        round_half(rate, 4).cast(RATE).alias("list_margin_rate"),
    )


def stg_orders(raw: DataFrame) -> DataFrame:
    """P3 with the delivery SLA columns D1-D4 defined once (P3a-P3d, trap T1)."""
    order_date = _typed(raw, "order_date", "date")
    promised = _typed(raw, "promised_delivery_date", "date", True)
    shipped = _typed(raw, "shipped_date", "date", True)
    delivered = _typed(raw, "delivered_date", "date", True)
    return raw.select(
        "order_id", "customer_id",
        order_date.alias("order_date"),
        month_start(order_date).alias("order_month"),
        "order_channel",
        _typed(raw, "order_sequence", "int").alias("order_sequence"),
        _flag(raw, "is_shipped").alias("is_shipped"),
        "fulfilment_centre",
        _blank_null(raw, "carrier").alias("carrier"),
        promised.alias("promised_delivery_date"),
        shipped.alias("shipped_date"),
        delivered.alias("delivered_date"),
        _typed(raw, "shipping_fee_charged", DEC12).alias("shipping_fee_charged"),
        _typed(raw, "shipping_cost", DEC12).alias("shipping_cost"),
        "payment_method",
        _blank_null(raw, "promo_code").alias("promo_code"),
        "order_status",
        day_diff(shipped, delivered).alias("transit_days"),
        day_diff(order_date, delivered).alias("days_to_deliver"),
        # greatest() skips NULLs, so an undelivered order has 0 days late.
        F.greatest(day_diff(promised, delivered), F.lit(0).cast("long")).alias("days_late"),
        F.when(delivered.isNull(), F.lit(None).cast("boolean"))
         .when(delivered <= promised, F.lit(True))
         .otherwise(F.lit(False)).alias("is_on_time"),
    )


def typed_order_items(raw: DataFrame) -> DataFrame:
    """The typed columns of a line that the extract holds, before what P4 derives from them."""
    return raw.select(
        "order_item_id", "order_id", "product_id",
        _typed(raw, "quantity", "int").alias("quantity"),
        _typed(raw, "unit_price", DEC12).alias("unit_price"),
        _typed(raw, "discount_amount", DEC12).alias("discount_amount"),
    )


def with_line_amounts(lines: DataFrame) -> DataFrame:
    """What P4 derives from price, quantity and discount: on either side of a shuffle the same, and
    cheaper to compute behind it than to carry through it."""
    qty, price, disc = F.col("quantity"), F.col("unit_price"), F.col("discount_amount")
    gross = price * qty
    rate = F.try_divide(disc.cast("double"),
                        F.nullif(price.cast("double") * qty, F.lit(0.0)))
    return lines.withColumns({
        "gross_revenue": gross.cast(DecimalType(18, 2)),
        "net_revenue": (gross - disc).cast(DecimalType(18, 2)),
        "discount_rate": round_half(rate, 4).cast(RATE),
    })


def stg_order_items(raw: DataFrame) -> DataFrame:
    """gross = price x qty, net = gross - line discount, rate rounded to 4 dp."""
    return with_line_amounts(typed_order_items(raw))


def stg_returns(raw: DataFrame) -> DataFrame:
    """P5."""
    return raw.select(
        "return_id", "order_item_id",
        _typed(raw, "return_date", "date").alias("return_date"),
        _typed(raw, "quantity_returned", "int").alias("quantity_returned"),
        "return_reason",
        _flag(raw, "restocked").alias("is_restocked"),
        _typed(raw, "refund_amount", DEC12).alias("refund_amount"),
    )


def stg_marketing_spend(raw: DataFrame) -> DataFrame:
    """P6."""
    d = _typed(raw, "spend_date", "date")
    return raw.select(
        d.alias("spend_date"),
        month_start(d).alias("spend_month"),
        F.col("channel").alias("acquisition_channel"),
        "campaign",
        _typed(raw, "spend", DEC12).alias("spend"),
        _typed(raw, "impressions", "long").alias("impressions"),
        _typed(raw, "clicks", "long").alias("clicks"),
    )


class Staged:
    """The six staging frames, each built on first use from a :class:`Sources`-like
    object (any object with the six source attributes)."""

    def __init__(self, src):
        self.src = src

    @cached_property
    def customers(self) -> DataFrame:
        return stg_customers(self.src.customers)

    @cached_property
    def products(self) -> DataFrame:
        return stg_products(self.src.products)

    @cached_property
    def orders(self) -> DataFrame:
        return stg_orders(self.src.orders)

    @cached_property
    def order_items(self) -> DataFrame:
        return stg_order_items(self.src.order_items)

    @cached_property
    def order_lines(self) -> DataFrame:
        """``order_items`` without the derived amounts."""
        return typed_order_items(self.src.order_items)

    @cached_property
    def returns(self) -> DataFrame:
        return stg_returns(self.src.returns)

    @cached_property
    def marketing_spend(self) -> DataFrame:
        return stg_marketing_spend(self.src.marketing_spend)
