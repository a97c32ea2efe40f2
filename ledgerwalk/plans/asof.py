"""The customer dimension as it was at many dates, from one pass over the lines.

An order counts from its date on, a return from its own: each is a change to its customer
that falls in the span before the first as-of date that sees it. Changes are added up
per customer and span, and running totals over the spans give every date at once, as
many builds over sources cut at those dates would.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerwalk.functions.dates import day_diff, month_diff
from ledgerwalk.functions.numeric import MONEY_SUM, money, ratio, to_double
from ledgerwalk.plans.marts import MartBuild, experience_label

#: What a customer's changes add up to, and the types of the sums.
SUMS = {"units": "long", "net": MONEY_SUM, "cm": MONEY_SUM, "refunds": MONEY_SUM, "returned": "long", "lines": "long"}


def _span(day: Column, dates: list[datetime.date]) -> Column:
    """Number of the first of ``dates`` (rising) that is not before ``day``; null after the last."""
    at = F.lit(None).cast("int")
    for i, d in reversed(list(enumerate(dates))):
        at = F.when(day <= F.lit(d), F.lit(i)).otherwise(at)
    return at


def _changes(b: MartBuild, dates: list[datetime.date]) -> DataFrame:
    """Per customer, order and span: what the order's lines and returns change in it. One scan of the
    lines; an order's lines in a span are added up first, so that it counts once and a hot
    customer is pre-aggregated."""
    bare = money(to_double("net_revenue") - to_double("_unit_cost") * F.col("quantity") - F.col("_freight"))
    nothing = F.lit(0).cast("long")
    zero = F.lit(0).cast("decimal(14,2)")
    ordered = _span(F.col("order_date"), dates)
    seen = _span(F.greatest("order_date", "return_date"), dates)

    def change(span, sold, units, net, cm, refund, back):
        return F.struct(span.alias("span"), sold.alias("lines"), units.alias("units"), net.alias("net"), cm.alias("cm"),
                        refund.alias("refunds"), back.alias("returned"))

    events = F.array(
        change(ordered, F.lit(1).cast("long"), F.col("quantity").cast("long"), F.col("net_revenue").cast("decimal(18,2)"),
               bare, zero, nothing),
        F.when(F.col("is_returned"), change(
            seen, nothing, nothing, F.lit(0).cast("decimal(18,2)"),
            (F.col("contribution_margin") - bare).cast("decimal(14,2)"), F.col("refund_amount").cast("decimal(14,2)"),
            F.lit(1).cast("long"))))
    e = b.fact.select("customer_id", "order_id", "order_date", "order_month", F.explode(events).alias("e")).where("e IS NOT NULL")
    e = e.select("customer_id", "order_id", "order_date", "order_month", "e.*").where("span IS NOT NULL")
    return e.groupBy("customer_id", "order_id", "order_date", "order_month", "span").agg(
        *[F.sum(c).cast(t).alias(c) for c, t in SUMS.items()])


def _seen_orders(b: MartBuild, dates: list[datetime.date]) -> DataFrame:
    """For each date that has seen an order: ``span, as_of, horizon`` (last order date) and the first and
    last order month, ``lo`` and ``hi``. A row a date."""
    per = b.orders.select(_span(F.col("order_date"), dates).alias("span"), "order_date", "order_month").where(
        "span IS NOT NULL").groupBy("span").agg(F.max("order_date").alias("d"), F.min("order_month").alias("m0"),
                                                F.max("order_month").alias("m1"))
    spans = b.spark.createDataFrame(list(enumerate(dates)), "span int, as_of date")
    run = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return spans.join(per, "span", "left").select(
        "span", "as_of", F.max("d").over(run).alias("horizon"), F.min("m0").over(run).alias("lo"),
        F.max("m1").over(run).alias("hi"))


def as_of_customers(b: MartBuild, dates: list[datetime.date]) -> DataFrame:
    """``as_of, customer_id`` and the columns of the customer dimension that move with time: cohort, first
    order's date and experience, orders, units, lifetime sums, average order value, return
    rate, last order, tenure, recency, repeat and active flags.

    Each row equals the one of a build whose orders and returns later than the date are
    cut off: the horizon is the last order date seen, and customers without an order yet
    have no cohort. Returns before their order's date count from the order's date.
    """
    dates = sorted(set(dates))
    firsts = b.first_orders.select(
        F.col("customer_id").alias("_customer"), F.col("order_id").alias("_order"), F.col("order_date").alias("_first"),
        F.col("order_month").alias("_cohort"), F.coalesce("is_on_time", F.lit(True)).alias("_on_time"))
    per = _changes(b, dates)
    per = per.join(firsts, (per["order_id"] == firsts["_order"]) & (per["customer_id"] == firsts["_customer"]), "left")
    sold, first_back = F.col("lines") > 0, F.col("_order").isNotNull() & (F.col("returned") > 0)
    per = per.groupBy("customer_id", "span").agg(
        F.count_if(sold).alias("orders"), F.max(F.when(sold, F.col("order_date"))).alias("last_order_date"),
        F.bool_or(first_back).alias("first_back"), *[F.sum(c).cast(t).alias(c) for c, t in SUMS.items()])

    # one row a customer and date, running totals over a customer's dates
    as_of = F.explode(F.array(*[F.struct(F.lit(i).alias("span"), F.lit(d).alias("as_of")) for i, d in enumerate(dates)])).alias("d")
    grid = b.customers.select("customer_id", as_of).select("customer_id", "d.*")
    before = Window.partitionBy("customer_id").orderBy("span").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = grid.join(per, ["customer_id", "span"], "left").select(
        "customer_id", "as_of", "span",
        *[F.coalesce(F.sum(x).over(before), F.lit(0)).cast(SUMS.get(x, "long")).alias(x) for x in ("orders", *SUMS)],
        F.max("last_order_date").over(before).alias("last_order_date"),
        F.coalesce(F.max("first_back").over(before), F.lit(False)).alias("_back"))
    horizon = _seen_orders(b, dates).select("span", F.col("horizon").alias("_horizon"))
    c = c.join(F.broadcast(horizon), "span").join(firsts, c["customer_id"] == firsts["_customer"], "left")
    begun = F.col("_first") <= F.col("as_of")
    cohort, since = F.when(begun, F.col("_cohort")), day_diff("last_order_date", "_horizon")
    has = F.when(F.col("orders") > 0, F.col("orders"))
    return c.select(
        "as_of", "customer_id", cohort.alias("cohort_month"), F.when(begun, F.col("_first")).alias("first_order_date"),
        F.when(begun, experience_label(F.col("_on_time"), F.col("_back"))).alias("first_order_experience"),
        "orders", "units", F.col("net").alias("lifetime_net_revenue"), F.col("cm").alias("lifetime_contribution_margin"),
        F.col("refunds").alias("lifetime_refunds"), ratio("net", has, 2).alias("avg_order_value"),
        ratio("returned", F.when(F.col("lines") > 0, F.col("lines")), 4).alias("return_line_rate"), "last_order_date",
        (F.col("orders") > 1).alias("is_repeat_customer"),
        month_diff(cohort, "_horizon").alias("tenure_months"), since.alias("days_since_last_order"),
        F.coalesce(since <= 180, F.lit(False)).alias("is_active"))


def as_of_repeat_rates(b: MartBuild, dates: list[datetime.date], months: int = 12) -> DataFrame:
    """A4 at many dates: repeat rate by first-order experience for the cohorts that had ``months`` of
    history then, and its gap to 'Clean'."""
    horizon = _seen_orders(b, sorted(set(dates))).select(
        F.col("as_of").alias("_at"), F.add_months(F.trunc("horizon", "MM"), -months).alias("_cutoff"))
    c = as_of_customers(b, dates).join(F.broadcast(horizon), F.col("as_of") == F.col("_at"))
    g = c.filter(F.col("cohort_month") <= F.col("_cutoff")).groupBy("as_of", "first_order_experience").agg(
        F.count(F.lit(1)).alias("customers"), F.count_if("is_repeat_customer").alias("repeat_customers"))
    g = g.withColumn("repeat_rate", ratio("repeat_customers", F.col("customers")))
    of_date = Window.partitionBy("as_of")  # four rows a date
    clean = F.max(F.when(F.col("first_order_experience") == "Clean", F.col("repeat_rate"))).over(of_date)
    return g.withColumn("gap_to_clean", F.col("repeat_rate") - clean)


def as_of_payback(b: MartBuild, dates: list[datetime.date], period: int = 12) -> DataFrame:
    """A5 at many dates: cost per customer, payback multiple and margin per customer ``period`` months after
    signup, by channel, of the cohorts that had got there then."""
    dates = sorted(set(dates))
    members = b.signup_members.where("signup_month IS NOT NULL")
    months = _changes(b, dates).groupBy("customer_id", "order_month", "span").agg(F.sum("cm").cast(MONEY_SUM).alias("cm"))
    cm = months.join(members, "customer_id").where(month_diff("signup_month", "order_month").between(0, period))
    keys = ["acquisition_channel", "signup_month"]
    cm = cm.groupBy(*keys, "span").agg(F.sum("cm").cast(MONEY_SUM).alias("cm"))
    # a change counts at its own date and every later one
    cm = cm.select(*keys, F.explode(F.sequence("span", F.lit(len(dates) - 1))).alias("span"), "cm").groupBy(*keys, "span").agg(
        F.sum("cm").cast(MONEY_SUM).alias("cm"))
    there = F.add_months("signup_month", period)
    cohorts = b.channel_cac.crossJoin(F.broadcast(_seen_orders(b, dates))).where(there.between(F.col("lo"), F.col("hi")))
    c = cohorts.join(cm, [*keys, "span"], "left").groupBy("as_of", "acquisition_channel").agg(
        F.sum("acquisition_spend").alias("spend"), F.sum("cohort_customers").alias("customers"),
        F.sum(F.coalesce(F.col("cm"), F.lit(0).cast(MONEY_SUM))).alias("cm"))
    return c.select("as_of", "acquisition_channel", ratio("spend", F.col("customers")).alias("cac"),
                    ratio("cm", F.col("spend")).alias("payback_multiple"),
                    ratio("cm", F.col("customers")).alias("margin_per_customer"))


def month_ends(b: MartBuild, months: int = 12) -> list[datetime.date]:
    """The last ``months`` month ends of the orders, the last one at or after the horizon."""
    last = b.orders.agg(F.last_day(F.max("order_date")).alias("d")).first()["d"]
    if last is None:
        return []
    out = [last]
    while len(out) < months:
        out.append(out[-1].replace(day=1) - datetime.timedelta(days=1))
    return out[::-1]


def as_of_summary(b: MartBuild, months: int = 12) -> DataFrame:
    """M1b and M1d at the last twelve month ends: customers, who of them ordered, came back and is
    active, and the lifetime sums."""
    b = b.light
    c = as_of_customers(b, month_ends(b, months))
    return c.groupBy("as_of").agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(F.col("orders") > 0).alias("ordering_customers"),
        F.count_if("is_repeat_customer").alias("repeat_customers"), F.count_if("is_active").alias("active_customers"),
        F.sum("orders").alias("orders"),
        *[F.sum(x).cast(MONEY_SUM).alias(x) for x in ("lifetime_net_revenue", "lifetime_contribution_margin", "lifetime_refunds")])


def repeat_rates_by_month_end(b: MartBuild, months: int = 12) -> DataFrame:
    """A4 at the last twelve month ends."""
    b = b.light
    return as_of_repeat_rates(b, month_ends(b, months))


def payback_by_month_end(b: MartBuild, months: int = 12) -> DataFrame:
    """A5 at the last twelve month ends."""
    b = b.light
    return as_of_payback(b, month_ends(b, months))
