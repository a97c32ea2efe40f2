"""Chart queries V1-V10 and analytical answers A1-A7 over the marts.

Windows here only ever run over already-aggregated rows (categories, lanes,
reasons); totals for shares are such windows, so no mart is planned twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerwalk.functions.dates import month_start
from ledgerwalk.functions.numeric import MONEY_SUM, exact_avg, ratio as _div
from ledgerwalk.plans.marts import MartBuild
from ledgerwalk.plans.metrics import METRICS, Request, evaluate, evaluate_shared, in_range, member_of

def _all():
    """All rows of an aggregated frame (categories, lanes, reasons): totals for shares."""
    return Window.partitionBy()


# ------------------------------------------------------------------ sheets
def sheet_01(b: MartBuild, margin_basis: str = "Contribution Margin") -> DataFrame:
    """V1 Category Contribution: K108 by category."""
    return evaluate(b.fct_order_items, "fct_order_items", ["category"], ["K108"],
                    params={"margin_basis": margin_basis})


def sheet_02(b: MartBuild) -> DataFrame:
    """V2 Promised vs Realised Margin, per product."""
    return b.dim_product.groupBy("product_id", "category").agg(
        METRICS["K701"].build({}).alias(METRICS["K701"].name),
        exact_avg("list_margin_rate").alias("avg_list_margin_rate"),
        F.sum("net_revenue").cast(MONEY_SUM).alias("net_revenue"))


def sheet_03(b: MartBuild) -> DataFrame:
    """V3 Margin Trend by Category: monthly contribution margin."""
    f = b.fct_order_items.withColumn("month", month_start("order_month"))
    return f.groupBy("month", "category").agg(
        F.sum("contribution_margin").cast(MONEY_SUM).alias("contribution_margin"))


def sheet_04(b: MartBuild) -> DataFrame:
    """V4 Discount Elasticity: margin per unit by category x band."""
    return evaluate(b.fct_discount_bands, "fct_discount_bands",
                    ["category", "discount_band_rank", "discount_band"], ["K301"])


def sheet_05(b: MartBuild) -> DataFrame:
    """V5 Units per Line by Depth."""
    return evaluate(b.fct_discount_bands, "fct_discount_bands",
                    ["discount_band_rank", "category"], ["K304"])


def sheet_06(b: MartBuild) -> DataFrame:
    """V6 On-Time Rate by Lane."""
    return evaluate(b.fct_fulfilment_daily, "fct_fulfilment_daily",
                    ["fulfilment_centre", "carrier"], ["K201"])


def sheet_06_heatmap(b: MartBuild, carriers: list[str] | None = None) -> DataFrame:
    """V6 as a centre x carrier matrix (carriers as columns). Pass ``carriers`` to
    skip the extra job that finds the pivot values."""
    f = b.fct_fulfilment_daily
    return (f.groupBy("fulfilment_centre").pivot("carrier", carriers)
            .agg(_div(F.sum("on_time_orders"), F.sum("orders"))))


def sheet_07(b: MartBuild) -> DataFrame:
    """V7 Revenue on Late Parcels by month and carrier."""
    f = b.fct_fulfilment_daily.withColumn("month", month_start("order_month"))
    return f.groupBy("month", "carrier").agg(
        F.sum("late_net_revenue").cast(MONEY_SUM).alias("revenue_on_late_parcels"))


def sheet_08(b: MartBuild) -> DataFrame:
    """V8 First-Order Experience: repeat rate, periods 1..12."""
    return evaluate(b.fct_cohort_repeat, "fct_cohort_repeat",
                    ["period_index", "first_order_experience"], ["K401"],
                    filters=[in_range("period_index", 1, 12)])


def sheet_09(b: MartBuild) -> DataFrame:
    """V9 CAC Payback by Channel: margin net of CAC per customer, periods 0..18."""
    return evaluate(b.fct_channel_payback, "fct_channel_payback",
                    ["period_index", "acquisition_channel"], ["K502"],
                    filters=[in_range("period_index", 0, 18)])


def sheet_10(b: MartBuild) -> DataFrame:
    """V10 Return Reasons by Margin Lost."""
    return evaluate(b.fct_returns, "fct_returns", ["return_reason", "disposition"], ["K601"])


def shared_order_lines(b: MartBuild) -> DataFrame:
    """V1, V3 and all metrics of the order lines (K101-K108) from one scan of the published fact, one
    under another; ``request`` names the answer, columns that it doesn't have are NULL."""
    lines = b.sliced_lines("order_item_id", "order_id", "order_month", "order_sequence", "category", "is_returned", "gross_revenue",
                           "discount_amount", "net_revenue", "net_shipping_cost", "contribution_margin").fct_order_items
    f = lines.withColumn("month", month_start("order_month"))
    got = evaluate_shared(f, "fct_order_items", [
        Request("sheet_01", ("category",), ("K108",)),
        Request("sheet_03", ("month", "category"), (), sums=("contribution_margin",)),
        Request("metrics_order_lines", ("category",), tuple(f"K10{i}" for i in range(1, 9))),
        Request("repeat_lines", ("category",), ("K101",), filters=(F.col("order_sequence") > 1,)),
    ])
    out = None
    for name, rows in got.items():
        rows = rows.select(F.lit(name).alias("request"), "*")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def sheet_06_matrix(b: MartBuild, carriers: tuple[str, ...] = ("Carrier 0", "Carrier 1", "Carrier 2")) -> DataFrame:
    """V6 as a matrix with a column for each of ``carriers``."""
    return sheet_06_heatmap(b, list(carriers))


def lanes_of(b: MartBuild, centres: tuple[str, ...], carriers: tuple[str, ...]) -> DataFrame:
    """Lane metrics of some fulfilment centres and carriers only."""
    return evaluate(b.fct_fulfilment_daily, "fct_fulfilment_daily", ["fulfilment_centre", "carrier"],
                    ["K201", "K202", "K204"],
                    filters=[member_of("fulfilment_centre", centres), member_of("carrier", carriers)])


# ----------------------------------------------------------------- answers
def answer_q1(b: MartBuild) -> DataFrame:
    """A1 Category margin league: revenue, share, margin, rate and both rankings."""
    f = b.fct_order_items
    g = f.groupBy("category").agg(
        F.sum("net_revenue").cast(MONEY_SUM).alias("net_revenue"),
        F.sum("contribution_margin").cast(MONEY_SUM).alias("contribution_margin"))
    by_rev = Window.orderBy(F.col("net_revenue").desc())
    by_cm = Window.orderBy(F.col("contribution_margin").desc())
    return g.select(
        "category", "net_revenue",
        _div("net_revenue", F.sum("net_revenue").over(_all())).alias("revenue_share"),
        "contribution_margin",
        _div("contribution_margin", "net_revenue").alias("contribution_margin_rate"),
        F.rank().over(by_rev).alias("revenue_rank"),
        F.rank().over(by_cm).alias("margin_rank"),
    )


def answer_q2(b: MartBuild, deep_rank: int = 2) -> DataFrame:
    """A2 Discount response by category x band, with the category's deep-discount roll-up."""
    deep = F.col("discount_band_rank") >= deep_rank
    g = b.fct_discount_bands.groupBy("category", "discount_band_rank", "discount_band").agg(
        F.sum("units").alias("units"),
        F.sum("order_lines").alias("_lines"),
        F.sum("contribution_margin").cast(MONEY_SUM).alias("_margin"))
    category = Window.partitionBy("category")  # a category's bands, already aggregated
    return g.select(
        "category", "discount_band_rank", "discount_band", "units",
        _div("_margin", "units").alias("margin_per_unit"),
        _div("units", "_lines").alias("units_per_line"),
        F.sum(F.when(deep, F.col("units"))).over(category).alias("deep_discount_units"),
        F.sum(F.when(deep, F.col("_margin"))).over(category).cast(MONEY_SUM)
        .alias("deep_discount_margin"))


def answer_q3(b: MartBuild) -> DataFrame:
    """A3 Lane league: orders, on-time rate, late revenue and its share of all late revenue."""
    f = b.fct_fulfilment_daily
    g = f.groupBy("fulfilment_centre", "carrier").agg(
        F.sum("orders").alias("orders"),
        _div(F.sum("on_time_orders"), F.sum("orders")).alias("on_time_rate"),
        F.sum("late_net_revenue").cast(MONEY_SUM).alias("late_net_revenue"))
    total = F.sum("late_net_revenue").over(_all())
    return g.select("fulfilment_centre", "carrier", "orders", "on_time_rate", "late_net_revenue",
                    _div("late_net_revenue", total).alias("late_revenue_share"))


def answer_q3_weekly(b: MartBuild) -> DataFrame:
    """A3 by ISO week: orders, on-time rate and average days late per lane."""
    f = b.fct_fulfilment_daily.withColumn(
        "week", F.date_trunc("week", F.col("order_date")).cast("date"))
    return f.groupBy("week", "fulfilment_centre", "carrier").agg(
        F.sum("orders").alias("orders"),
        _div(F.sum("on_time_orders"), F.sum("orders")).alias("on_time_rate"),
        _div(F.sum("days_late_total"), F.sum("orders")).alias("average_days_late"))


def cohort_cutoff(b: MartBuild, months: int = 12) -> DataFrame:
    """One-row frame: the last cohort month with ``months`` of history before the horizon."""
    return b.horizon.select(
        F.add_months(F.trunc("as_of_date", "MM"), -months).alias("cutoff_month"))


def answer_q4(b: MartBuild, months: int = 12, period: int = 6) -> DataFrame:
    """A4 Repeat rate by first-order experience for mature cohorts, gap to 'Clean',
    and the repeat rate at ``period`` months (up to ``months``): one plan of the cohort's
    members, met by their activity in that month."""
    cut = F.broadcast(cohort_cutoff(b, months))
    profile = b.customer_profile.select("customer_id", "_orders", *b._first_order_columns())
    members = (b.customers.select("customer_id").join(profile, "customer_id")
               .crossJoin(cut).filter(F.col("cohort_month") <= F.col("cutoff_month"))
               .select("customer_id", "first_order_experience", (F.col("_orders") > 1).alias("_repeat"),
                       F.add_months("cohort_month", period).alias("order_month")))
    # a mature cohort has every period up to ``months``, so its members are the rate's base
    active = b.customer_month.select("customer_id", "order_month", F.lit(True).alias("_active"))
    g = members.join(active, ["customer_id", "order_month"], "left").groupBy("first_order_experience").agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if("_repeat").alias("repeat_customers"),
        _div(F.count_if("_repeat"), F.count(F.lit(1))).alias("repeat_rate"),
        _div(F.count("_active"), F.count(F.lit(1))).alias("period_active_rate"))
    clean = F.max(F.when(F.col("first_order_experience") == "Clean", F.col("repeat_rate"))).over(_all())
    return g.select("first_order_experience", "customers", "repeat_customers", "repeat_rate",
                    (F.col("repeat_rate") - clean).alias("gap_to_clean"), "period_active_rate")


def answer_q5(b: MartBuild, period: int = 12) -> DataFrame:
    """A5 Payback ``period`` months after signup, by channel."""
    k = METRICS["K501"], METRICS["K503"]
    return (b.fct_channel_payback.filter(F.col("period_index") == period)
            .groupBy("acquisition_channel")
            .agg(*[m.build({}).alias(m.name) for m in k],
                 _div(F.sum("cumulative_contribution_margin"), F.sum("cohort_customers"))
                 .alias("margin_per_customer")))


def answer_breakeven(b: MartBuild) -> DataFrame:
    """A5b First period at which a channel's cumulative margin net of CAC is >= 0."""
    p = b.fct_channel_payback.groupBy("acquisition_channel", "period_index").agg(
        F.sum("cumulative_margin_net_of_cac").alias("net"))
    chans = p.groupBy("acquisition_channel").agg(
        F.min(F.when(F.col("net") >= 0, F.col("period_index"))).alias("breakeven_period"),
        F.max("period_index").alias("periods_observed"))
    return chans


def answer_q6(b: MartBuild) -> DataFrame:
    """A6 Return-reason Pareto: margin lost vs count, ranks and cumulative share."""
    r = b.fct_returns.groupBy("return_reason").agg(
        F.sum("margin_lost").cast(MONEY_SUM).alias("margin_lost"),
        F.count(F.lit(1)).alias("returns"))
    lost, count = F.sum("margin_lost").over(_all()), F.sum("returns").over(_all())
    by_m = Window.orderBy(F.col("margin_lost").desc(), F.col("return_reason"))
    by_n = Window.orderBy(F.col("returns").desc())
    run = by_m.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return r.select(
        "return_reason", "margin_lost", "returns",
        _div("margin_lost", "returns").alias("margin_lost_per_return"),
        _div("margin_lost", lost).alias("share_of_margin_lost"),
        _div("returns", count).alias("share_of_returns"),
        F.rank().over(Window.orderBy(F.col("margin_lost").desc())).alias("rank_by_margin"),
        F.rank().over(by_n).alias("rank_by_count"),
        _div(F.sum("margin_lost").over(run), lost).alias("cumulative_share"),
    )


def answer_return_products(b: MartBuild, top: int | None = None) -> DataFrame:
    """A6b Products driving returns: every reason x product, with its share of the reason's
    margin lost and the unit return rate. ``top``: keep only so many products per reason.

    The reason totals are an aggregate joined back (a handful of rows); a rank is
    computed only for ``top``, and block-wise, so that no task holds a whole reason.
    """
    r = b.fct_returns.groupBy("return_reason", "product_id").agg(
        F.sum("quantity_returned").alias("units_returned"),
        F.sum("margin_lost").cast(MONEY_SUM).alias("margin_lost"),
        F.first("category").alias("category"))
    if top is not None:
        from ledgerwalk.operators.ranking import row_number_within

        block = F.floor(F.log2(F.greatest(F.lit(1.0), F.col("margin_lost").cast("double"))) * -8)
        r = row_number_within(r.withColumn("_block", block), ["return_reason"], "_block",
                              [F.col("margin_lost").desc(), F.col("product_id")], "_rank")
        r = r.filter(F.col("_rank") <= top).drop("_block", "_rank")
    lost = b.fct_returns.groupBy("return_reason").agg(
        F.sum("margin_lost").cast(MONEY_SUM).alias("_lost"))
    sold = b.fact.groupBy("product_id").agg(F.sum("quantity").alias("units_sold"))
    return (r.join(lost, r["return_reason"].eqNullSafe(lost["return_reason"]))
            .drop(lost["return_reason"]).join(sold, "product_id", "left")
            .select("return_reason", "product_id", "category", "units_returned", "margin_lost",
                    _div("margin_lost", "_lost").alias("share_of_reason"),
                    _div("units_returned", "units_sold").alias("unit_return_rate")))


def headline_kpis(b: MartBuild) -> DataFrame:
    """A7 Headline KPIs: one row, from the order rollup joined once to the order header."""
    r = b.order_rollup.select("order_id", "_customer_known", "net_revenue", "contribution_margin")
    known = F.col("_customer_known")
    sent = F.col("is_shipped") & F.col("delivered_date").isNotNull()
    o = b.orders.select("order_id", "is_shipped", "delivered_date", "is_on_time").join(r, "order_id")
    one = o.agg(
        F.sum(F.when(known, F.col("net_revenue"))).cast(MONEY_SUM).alias("net_revenue"),
        F.sum(F.when(known, F.col("contribution_margin"))).cast(MONEY_SUM).alias("contribution_margin"),
        F.count_if(known).alias("orders"),
        _div(F.count_if(sent & F.col("is_on_time")), F.count_if(sent)).alias("on_time_rate"))
    customers = b.stg.customers.agg(F.count(F.lit(1)).alias("customers"))
    return one.crossJoin(F.broadcast(customers)).select(
        "net_revenue", "contribution_margin",
        _div("contribution_margin", "net_revenue").alias("contribution_margin_rate"),
        "orders", "on_time_rate", "customers")
