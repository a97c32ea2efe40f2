"""Order-line economics I1-I9: the margin walk from list price to contribution margin.

Rules that every later model inherits: a basket's parcel costs go to its lines in
proportion to what they earned (equally, if the basket earned nothing); refunds are taken
off in full, while goods count as recovered only when units went back on the shelf; and a
return belongs to the month of its order.

Plan shape: basket totals are an aggregate (map-side combined) joined to the
order header at order grain; the customer context that the published line fact
needs (channel, region, cohort month) is attached at order grain too, so the line
rows are shuffled once per join key (order, product, line) and the published
line and return facts are projections of this frame, not further joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DecimalType

from ledgerwalk.functions.numeric import money, to_double
from ledgerwalk.operators.allocation import allocate_share, group_totals
from ledgerwalk.operators.topk import first_per_key
from ledgerwalk.plans.staging import Staged, with_line_amounts

DEC12 = DecimalType(12, 2)

# The reference column list of the line-economics model.
ECONOMICS_COLUMNS = [
    "order_item_id", "order_id", "product_id", "customer_id",
    "order_date", "order_month", "order_channel", "order_sequence", "is_shipped",
    "fulfilment_centre", "carrier", "is_on_time", "days_late", "promo_code",
    "category", "subcategory", "brand", "weight_kg",
    "quantity", "unit_price", "gross_revenue", "discount_amount", "net_revenue", "discount_rate",
    "is_returned", "return_reason", "quantity_returned", "refund_amount", "is_restocked",
    "return_date",
    "cogs_gross", "cogs_recovered", "cogs_net",
    "shipping_cost_allocated", "shipping_fee_allocated", "net_shipping_cost",
    "realised_revenue", "contribution_margin",
]


def basket_allocation(items: DataFrame) -> DataFrame:
    """I1 + I2: each line with its basket totals and its freight share."""
    totals = group_totals(items, "order_id", "net_revenue",
                          "order_net_revenue", "order_line_count")
    return items.join(totals, "order_id").select(
        "order_item_id", "order_id", "net_revenue", "order_net_revenue", "order_line_count",
        allocate_share("net_revenue", "order_net_revenue", "order_line_count").alias("revenue_share"),
    )


def first_orders(orders: DataFrame) -> DataFrame:
    """Each customer's first order by (order_date, order_id)."""
    return first_per_key(orders, "customer_id", ["order_date", "order_id"])


def cohort_months(orders: DataFrame) -> DataFrame:
    """The month of each customer's first order (I11), as an aggregate. The first order is the one
    of the least date, undated ones first, so its month is the least one or missing."""
    m = F.col("order_month")
    first = orders.groupBy("customer_id").agg(F.min(m).alias("_first"), F.bool_or(m.isNull()).alias("_undated"))
    return first.select("customer_id", F.when(~F.col("_undated"), F.col("_first")).alias("cohort_month"))


def line_fact(stg: Staged, orders: DataFrame | None = None, months: DataFrame | None = None) -> DataFrame:
    """Wide line fact: I9's columns plus raw return fields and customer context.

    ``months`` (column ``order_month``): only lines of orders in these months, which are
    picked before any other join; first orders are still those of all orders.
    """
    items = stg.order_lines
    orders = stg.orders if orders is None else orders
    picked = orders
    if months is not None:
        picked = orders.join(F.broadcast(months), "order_month", "left_semi")
        items = items.join(picked.select("order_id"), "order_id", "left_semi")
    return line_economics(items, order_context(stg, orders, picked), line_returns(stg), line_products(stg))


def order_context(stg: Staged, orders: DataFrame, picked: DataFrame | None = None) -> DataFrame:
    """The header of each order (of ``picked`` ones) with its customer's context; cohort months are
    those of all ``orders``."""
    cust_ctx = stg.customers.select(
        "customer_id", "acquisition_channel", "region", F.lit(True).alias("_customer_known")
    ).join(cohort_months(orders), "customer_id", "left")
    return (
        (orders if picked is None else picked).select(
            "order_id", "customer_id", "order_date", "order_month", "order_channel",
            "order_sequence", "is_shipped", "fulfilment_centre", "carrier", "is_on_time",
            "days_late", "promo_code", "shipping_cost", "shipping_fee_charged")
        .join(cust_ctx, "customer_id", "left")
    )


def line_products(stg: Staged) -> DataFrame:
    """What a line needs of its product."""
    return stg.products.select("product_id", "category", "subcategory", "brand", "weight_kg", "unit_cost")


def line_returns(stg: Staged) -> DataFrame:
    """What a line needs of its return."""
    return stg.returns.select(
        "order_item_id",
        F.col("return_id"),
        F.col("return_id").isNotNull().alias("_returned"),
        F.col("return_reason"),
        F.col("return_date"),
        F.col("quantity_returned").alias("_r_quantity"),
        F.col("refund_amount").alias("_r_refund"),
        F.col("is_restocked").alias("_r_restocked"),
        F.lit(True).alias("_has_return"),
    )


def line_economics(items: DataFrame, context: DataFrame, returns: DataFrame, products: DataFrame) -> DataFrame:
    """The wide line fact of whole orders: ``items`` with ``order_context``, ``line_returns`` and
    ``line_products``."""
    totals = group_totals(with_line_amounts(items), "order_id", "net_revenue",
                          "order_net_revenue", "order_line_count")
    # customers first: what is then dealt out by order meets the totals and the lines there
    order_side = context.join(totals, "order_id")
    # returns meet the narrow staged lines (shuffled by order_item_id while they are
    # six columns wide); the inner joins after it only drop lines, so the result is
    # the same as attaching returns last, without a second shuffle of the wide rows.
    # The derived amounts and the flag need no column that the shuffles don't carry anyway.
    lines = with_line_amounts(
        items.join(returns, "order_item_id", "left")
        .join(order_side, "order_id")
        .join(products, "product_id")
    )

    share = allocate_share("net_revenue", "order_net_revenue", "order_line_count")
    freight = to_double("shipping_cost") - to_double("shipping_fee_charged")
    return with_return_economics(lines.select(
        "order_item_id", "order_id", "product_id", "customer_id",
        "order_date", "order_month", "order_channel", "order_sequence", "is_shipped",
        "fulfilment_centre", "carrier", "is_on_time", "days_late", "promo_code",
        "category", "subcategory", "brand", "weight_kg",
        "quantity", "unit_price", "gross_revenue", "discount_amount", "net_revenue",
        "discount_rate",
        "return_reason", "return_date",
        money(to_double("unit_cost") * F.col("quantity")).alias("cogs_gross"),
        money(to_double("shipping_cost") * share).alias("shipping_cost_allocated"),
        money(to_double("shipping_fee_charged") * share).alias("shipping_fee_allocated"),
        money(freight * share).alias("net_shipping_cost"),
        # carried for the return fact and the published line fact
        "return_id", "_has_return", "_r_quantity", "_r_refund", "_r_restocked",
        "acquisition_channel", "region", "cohort_month",
        F.coalesce(F.col("_customer_known"), F.lit(False)).alias("_customer_known"),
        # carried for lines whose return arrives later
        F.col("unit_cost").alias("_unit_cost"), (freight * share).alias("_freight"),
        F.coalesce(F.col("_returned"), F.lit(False)).alias("is_returned"),
    ))


def with_return_economics(lines: DataFrame) -> DataFrame:
    """I4-I8: the columns of a line that its return decides, from ``is_returned``, the raw return
    fields (``_r_quantity, _r_refund, _r_restocked``), the unit cost and the line's freight.
    """
    restocked = F.coalesce(F.col("_r_restocked"), F.lit(False))
    qty_ret = F.coalesce(F.col("_r_quantity"), F.lit(0))
    kept_back = F.when(restocked, qty_ret).otherwise(F.lit(0))
    cost, net = to_double("_unit_cost"), to_double("net_revenue")
    refund = F.coalesce(to_double("_r_refund"), F.lit(0.0))
    return lines.withColumns({
        "quantity_returned": qty_ret,
        "refund_amount": F.coalesce(F.col("_r_refund"), F.lit(0).cast(DEC12)).cast(DEC12),
        "is_restocked": restocked,
        "cogs_recovered": money(cost * kept_back),
        "cogs_net": money(cost * (F.col("quantity") - kept_back)),
        "realised_revenue": money(net - refund),
        "contribution_margin": money(net - refund - cost * (F.col("quantity") - kept_back) - F.col("_freight")),
    })


#: Raw fields of a line's return, by the staged column that they come from.
RETURN_FIELDS = {"return_id": "return_id", "return_reason": "return_reason", "return_date": "return_date",
                 "_r_quantity": "quantity_returned", "_r_refund": "refund_amount", "_r_restocked": "is_restocked"}


def with_late_returns(lines: DataFrame, returns: DataFrame) -> DataFrame:
    """Stored lines with staged ``returns`` put on them; a line's later return replaces its earlier one."""
    late = returns.select(F.col("order_item_id").alias("_late_item"),
                          *[F.col(c).alias(f"_late_{k}") for k, c in RETURN_FIELDS.items()])
    j = lines.join(late, lines["order_item_id"] == late["_late_item"], "left")
    arrived = F.col("_late_item").isNotNull()
    j = j.withColumns({k: F.when(arrived, F.col(f"_late_{k}")).otherwise(F.col(k)) for k in RETURN_FIELDS}
                      | {"_has_return": F.when(arrived, F.lit(True)).otherwise(F.col("_has_return"))})
    j = j.withColumn("is_returned", F.col("return_id").isNotNull())
    return with_return_economics(j.drop(*late.columns)).select(*lines.columns)


def order_item_economics(fact: DataFrame) -> DataFrame:
    """The published column set of the line economics."""
    return fact.select(*ECONOMICS_COLUMNS)


def exact_freight_allocation(stg: Staged, orders: DataFrame | None = None,
                             block_lines: int | None = None) -> DataFrame:
    """T8 option: net freight per line by largest remainder, so the lines of an order
    add up to its header freight to the penny (the published margin walk keeps the
    per-line rounding). Orders of more than ``block_lines`` lines, of which there can only be few, are
    ranked in blocks; all others where the join with their header has put them."""
    from ledgerwalk.operators.allocation import BLOCK_LINES, allocate_exact, allocate_exact_small
    from ledgerwalk.session import run_folder
    from ledgerwalk.sources.publish import materialise_frame

    block_lines = BLOCK_LINES if block_lines is None else block_lines
    orders = stg.orders if orders is None else orders
    hdr = orders.select(
        "order_id",
        ((F.col("shipping_cost") - F.col("shipping_fee_charged")) * 100).cast("long")
        .alias("freight_cents"))

    def lines(items: DataFrame) -> DataFrame:
        return basket_allocation(items).join(hdr, "order_id")

    how = ("order_id", "order_item_id", "freight_cents", "revenue_share", "freight_cents_allocated")
    small = lines(stg.order_items).filter(F.col("order_line_count") <= block_lines)
    out = allocate_exact_small(small, *how)
    large = stg.order_items.groupBy("order_id").count().filter(F.col("count") > block_lines).select("order_id")
    large = materialise_frame(large, run_folder(large.sparkSession, "allocation"), "large_orders")
    if not large.isEmpty():
        of_large = lines(stg.order_items.join(large, "order_id", "left_semi"))
        out = out.unionByName(allocate_exact(of_large, *how))
    return out.select(
        "order_item_id", "order_id", "revenue_share", "freight_cents",
        (F.col("freight_cents_allocated").cast(DecimalType(20, 0)) / 100)
        .cast(DecimalType(14, 2)).alias("net_shipping_cost_exact"))
