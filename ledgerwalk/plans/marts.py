"""Intermediate models I10-I14 and the eight marts M1-M8.

:class:`MartBuild` wires the model DAG lazily. The order rollup, which several marts
read more than once, is always written to the shared folder and read again; with
``materialise=True`` so are the order header and the wide line fact, which cuts their
lineage and avoids recomputing the economics per mart. ``stored`` gives marts from one
such build, for checks that read many of them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from ledgerwalk.functions.banding import DEFAULT_BAND_EDGES, band_columns
from ledgerwalk.functions.dates import day_diff, month_diff
from ledgerwalk.functions.numeric import MONEY_SUM, exact_avg, money, ratio, round_half, to_double
from ledgerwalk.operators import cohorts as G
from ledgerwalk.plans import economics as E
from ledgerwalk.plans.staging import Staged
from ledgerwalk.sources.contracts import MART_COLUMNS
from ledgerwalk.sources.extracts import Sources

DEC12 = DecimalType(12, 2)


def _msum(c: str) -> F.Column:
    """Exact decimal sum in the money-sum type."""
    return F.sum(c).cast(MONEY_SUM)


def experience_label(on_time, returned) -> F.Column:
    """Four-way first-order experience."""
    late = ~on_time
    return (
        F.when(late & returned, F.lit("Late and returned"))
        .when(late, F.lit("Delivered late"))
        .when(returned, F.lit("Returned"))
        .otherwise(F.lit("Clean"))
    )


class MartBuild:
    """The model DAG over one set of sources."""

    def __init__(self, src: Sources, band_edges=DEFAULT_BAND_EDGES,
                 materialise: bool = False, folder: str | None = None,
                 fact_path: str | None = None, store_rollup: bool = True,
                 buckets: int | None = None):
        """``fact_path``: read the wide line fact from a stored (e.g. restated) copy
        instead of computing it. ``store_rollup`` off: not even the order rollup is stored,
        for plans that need few of its columns, which then prune the rest. ``buckets``: the
        header, the roll-up, the customers, their profiles and their months are stored
        co-located, bucketed by order or customer, so that the marts join without shuffles."""
        self.src = src
        self.fact_path = fact_path
        self.stg = Staged(src)
        self.band_edges = tuple(band_edges)
        self.materialise = materialise or bool(buckets)
        self.buckets = buckets
        self.folder = folder
        self.store_rollup = store_rollup
        self.fact_folders: list[str] = []
        self._stored: dict[str, DataFrame] | None = None

    @property
    def spark(self) -> SparkSession:
        return self.stg.customers.sparkSession

    # ------------------------------------------------------------ intermediate
    def _keep(self, df: DataFrame, name: str, always: bool = False, key: str | None = None) -> DataFrame:
        if not (self.materialise or always):
            return df
        from ledgerwalk.sources.colocated import store_bucketed
        from ledgerwalk.sources.publish import materialise_frame

        if self.buckets and key:
            return store_bucketed(df, self._own_folder(), name, key, self.buckets)
        return materialise_frame(df, self._own_folder(), name)

    def _own_folder(self) -> str:
        from ledgerwalk.session import run_folder

        if self.folder is None:
            self.folder = run_folder(self.spark, "build")
        return self.folder

    def _colocate(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """Stored by ``key`` in a co-located build, else as planned."""
        return self._keep(df, name, key=key) if self.buckets else df

    @cached_property
    def orders(self) -> DataFrame:
        """Staged order header; read by the economics, first orders, fulfilment, spine and
        horizon. A build that materialises stores it co-located, or once where it has to be
        parsed from text; a typed extract is as cheap to read as a copy of it."""
        from pyspark.sql.types import StringType

        parsed = isinstance(self.src.orders.schema["order_date"].dataType, StringType)
        staged = self.stg.orders
        return self._keep(staged, "stg_orders", key="order_id") if self.buckets or parsed else staged

    @cached_property
    def customers(self) -> DataFrame:
        """Staged customers; co-located with their profiles and months."""
        return self._colocate(self.stg.customers, "stg_customers", "customer_id")

    @cached_property
    def fact(self) -> DataFrame:
        if self.fact_path:
            return self.spark.read.parquet(self.fact_path)
        if not self.materialise:
            return E.line_fact(self.stg, self.orders)
        from ledgerwalk.plans.slices import store_line_fact

        fact, self.fact_folders = store_line_fact(
            self.stg, self.orders, self._own_folder(), slices=self.slices, shape=self.fact_shape)
        return fact

    @cached_property
    def slices(self) -> int:
        """Slices of orders in which a build that materialises stores the line fact; 1 for few lines."""
        from ledgerwalk.plans.slices import slices_of

        return slices_of(self.stg.order_lines)

    def in_slices(self, shape: Callable[[DataFrame], DataFrame], folder: str | None = None) -> DataFrame:
        """``shape`` of the line fact, line by line: stored in slices of orders where it takes more than
        one, so that the shuffles of one stand at a time, and else as a plan."""
        from ledgerwalk.plans.slices import store_line_fact
        from ledgerwalk.session import run_folder

        stored = self.materialise or self.fact_path or "fact" in self.__dict__ or type(self).fact is not MartBuild.fact
        if stored or self.slices == 1:
            return shape(self.fact)
        return store_line_fact(self.stg, self.orders, folder or run_folder(self.spark, "lines"),
                               slices=self.slices, shape=shape)[0]

    def sliced_lines(self, *columns: str) -> "MartBuild":
        """A build whose published lines are these columns of them, stored in slices of orders; where one
        slice holds all lines, ``light``."""
        if self.light is self or self.light.slices == 1:
            return self.light
        k = MartBuild(self.src, self.band_edges, store_rollup=False)
        k.__dict__["fct_order_items"] = self.light.in_slices(lambda fact: self.published_lines(fact).select(*columns))
        return k

    @staticmethod
    def fact_shape(fact: DataFrame) -> DataFrame:
        """What a build that materialises stores of the line fact."""
        return fact

    @cached_property
    def economics(self) -> DataFrame:
        return E.order_item_economics(self.fact)

    @cached_property
    def basket_allocation(self) -> DataFrame:
        return E.basket_allocation(self.stg.order_items)

    @cached_property
    def bounds(self) -> DataFrame:
        return G.spine_bounds(self.orders, "order_month")

    @cached_property
    def month_spine(self) -> DataFrame:
        return G.month_spine(self.bounds)

    @cached_property
    def first_orders(self) -> DataFrame:
        return E.first_orders(self.orders)

    @cached_property
    def order_rollup(self) -> DataFrame:
        """I12 (widened): one row per order of the line fact, all additive measures.
        Stored: the customer profile, fulfilment and cohort activity read it, some twice."""
        return self._keep(self._order_rollup(), "order_rollup", always=self.store_rollup, key="order_id")

    def _order_rollup(self) -> DataFrame:
        f = self.fact
        return f.groupBy("order_id", "customer_id", "order_date", "order_month",
                         "_customer_known").agg(
            F.count(F.lit(1)).alias("order_lines"),
            F.sum("quantity").cast("long").alias("units"),
            F.sum("net_revenue").alias("net_revenue"),
            F.sum("realised_revenue").alias("realised_revenue"),
            F.sum("contribution_margin").alias("contribution_margin"),
            F.sum("refund_amount").alias("refund_amount"),
            F.count_if(F.col("is_returned")).alias("returned_lines"),
            F.bool_or("is_returned").alias("had_return"),
        )

    @cached_property
    def customer_profile(self) -> DataFrame:
        """First order and lifetime of each ordering customer in one pass: the order header
        meets its rollup once, and one aggregate per customer keeps the sums and the
        first order's columns (min_by on date and order id)."""
        r = self.order_rollup.select(
            "order_id", "had_return", "order_lines", "units", "net_revenue",
            "contribution_margin", "refund_amount", "returned_lines")
        o = self.orders.join(r, "order_id", "left")
        first = F.min_by(
            F.struct("order_id", "order_date", "order_month", "order_channel", "fulfilment_centre",
                     "carrier", "is_on_time", "days_late", "had_return", "net_revenue",
                     "contribution_margin"),
            F.struct("order_date", "order_id"))
        sold = F.col("order_lines").isNotNull()  # orders without lines have no lifetime
        profile = o.groupBy("customer_id").agg(
            first.alias("first"),
            F.count_if(sold).alias("_orders"),
            F.sum("order_lines").alias("_lines"),
            F.sum("units").alias("_units"),
            F.sum("net_revenue").alias("_net"),
            F.sum("contribution_margin").alias("_cm"),
            F.sum("refund_amount").alias("_refunds"),
            F.sum("returned_lines").alias("_returned"),
            F.max(F.when(sold, F.col("order_date"))).alias("last_order_date"),
        )
        return self._colocate(profile, "customer_profile", "customer_id")

    @cached_property
    def customer_first_order(self) -> DataFrame:
        """One row per ordering customer describing the first order."""
        return self.customer_profile.select("customer_id", *self._first_order_columns())

    @staticmethod
    def _first_order_columns() -> list[F.Column]:
        on_time = F.coalesce(F.col("first.is_on_time"), F.lit(True))
        returned = F.coalesce(F.col("first.had_return"), F.lit(False))
        return [
            F.col("first.order_id").alias("first_order_id"),
            F.col("first.order_date").alias("first_order_date"),
            F.col("first.order_month").alias("cohort_month"),
            F.col("first.order_channel").alias("first_order_channel"),
            F.col("first.fulfilment_centre").alias("first_order_fulfilment_centre"),
            F.col("first.carrier").alias("first_order_carrier"),
            on_time.alias("first_order_on_time"),
            F.coalesce(F.col("first.days_late"), F.lit(0).cast("long")).alias("first_order_days_late"),
            returned.alias("first_order_returned"),
            F.coalesce(F.col("first.net_revenue"), F.lit(0)).cast(DEC12).alias("first_order_net_revenue"),
            F.coalesce(F.col("first.contribution_margin"), F.lit(0)).cast(DEC12).alias("first_order_margin"),
            experience_label(on_time, returned).alias("first_order_experience"),
        ]

    @cached_property
    def horizon(self) -> DataFrame:
        """The data horizon as a one-row frame (never a driver value)."""
        return self.orders.agg(F.max("order_date").alias("as_of_date"))

    # ------------------------------------------------------------------ marts
    @cached_property
    def dim_customer(self) -> DataFrame:
        """M1: every staged customer, with the profile of those who ordered."""
        profile = self.customer_profile.select("*", *self._first_order_columns())
        # a customer without an order has no first order, so nothing of it is defaulted
        c = (self.customers.join(profile, "customer_id", "left")
             .crossJoin(F.broadcast(self.horizon)))
        orders = F.coalesce(F.col("_orders"), F.lit(0).cast("long"))
        net = F.coalesce(F.col("_net"), F.lit(0)).cast(MONEY_SUM)
        since = day_diff("last_order_date", "as_of_date")
        return c.select(
            "customer_id", "signup_date", "signup_month", "acquisition_channel", "region", "city",
            "is_marketing_opt_in",
            "cohort_month", "first_order_date", "first_order_channel", "first_order_experience",
            "first_order_on_time", "first_order_returned", "first_order_net_revenue",
            orders.alias("orders"),
            F.coalesce(F.col("_units"), F.lit(0).cast("long")).alias("units"),
            net.alias("lifetime_net_revenue"),
            F.coalesce(F.col("_cm"), F.lit(0)).cast(MONEY_SUM).alias("lifetime_contribution_margin"),
            F.coalesce(F.col("_refunds"), F.lit(0)).cast(MONEY_SUM).alias("lifetime_refunds"),
            ratio(net, F.col("_orders"), 2).alias("avg_order_value"),
            ratio(F.coalesce(F.col("_returned"), F.lit(0)), F.col("_lines"), 4).alias("return_line_rate"),
            "last_order_date",
            (orders > 1).alias("is_repeat_customer"),
            month_diff("cohort_month", "as_of_date").alias("tenure_months"),
            since.alias("days_since_last_order"),
            F.coalesce(since <= 180, F.lit(False)).alias("is_active"),
        )

    @cached_property
    def product_performance(self) -> DataFrame:
        """Sums over the lines of each product."""
        return self.fact.groupBy("product_id").agg(
            F.count(F.lit(1)).alias("_lines"),
            F.sum("quantity").cast("long").alias("_sold"),
            F.sum("quantity_returned").cast("long").alias("_returned"),
            _msum("gross_revenue").alias("_gross"),
            _msum("discount_amount").alias("_disc"),
            _msum("net_revenue").alias("_net"),
            _msum("refund_amount").alias("_refund"),
            _msum("cogs_net").alias("_cogs"),
            _msum("net_shipping_cost").alias("_ship"),
            _msum("contribution_margin").alias("_cm"),
        )

    @cached_property
    def dim_product(self) -> DataFrame:
        """M2."""
        perf = self.product_performance
        p = self.stg.products.join(perf, "product_id", "left")

        def z(c, t):
            return F.coalesce(F.col(c), F.lit(0).cast(t))

        realised_rate = ratio("_cm", "_net")
        return p.select(
            "product_id", "sku", "product_name", "category", "subcategory", "brand",
            "unit_cost", "list_price", "weight_kg", "list_margin_rate",
            z("_lines", "long").alias("order_lines"),
            z("_sold", "long").alias("units_sold"),
            z("_returned", "long").alias("units_returned"),
            z("_gross", MONEY_SUM).alias("gross_revenue"),
            z("_disc", MONEY_SUM).alias("discount_amount"),
            z("_net", MONEY_SUM).alias("net_revenue"),
            z("_refund", MONEY_SUM).alias("refund_amount"),
            z("_cogs", MONEY_SUM).alias("cogs"),
            z("_ship", MONEY_SUM).alias("net_shipping_cost"),
            z("_cm", MONEY_SUM).alias("contribution_margin"),
            ratio("_disc", "_gross", 4).alias("avg_discount_rate"),
            ratio("_returned", "_sold", 4).alias("unit_return_rate"),
            round_half(realised_rate, 4).alias("contribution_margin_rate"),
            round_half(realised_rate - to_double("list_margin_rate"), 4).alias("margin_rate_vs_list"),
        )

    @cached_property
    def fct_order_items(self) -> DataFrame:
        """M3: the published line fact - a projection (customer context is already on it)."""
        return self.published_lines(self.fact)

    def published_lines(self, fact: DataFrame) -> DataFrame:
        """M3 of some lines of the line fact."""
        label, rank = band_columns("discount_rate", self.band_edges)
        f = fact.filter(F.col("_customer_known"))
        return f.select(
            "order_item_id", "order_id", "customer_id", "product_id",
            "order_date", "order_month", "order_channel", "order_sequence",
            (F.col("order_sequence") == 1).alias("is_first_order"),
            "acquisition_channel", "region", "cohort_month",
            "is_shipped", "fulfilment_centre", "carrier", "is_on_time", "days_late",
            "category", "subcategory", "brand",
            "quantity", "unit_price", "gross_revenue", "discount_amount", "net_revenue",
            "discount_rate", label.alias("discount_band"), rank.alias("discount_band_rank"),
            "is_returned", "return_reason", "quantity_returned", "refund_amount", "is_restocked",
            F.col("cogs_net").alias("cogs"), "net_shipping_cost", "realised_revenue",
            "contribution_margin",
        )

    @cached_property
    def fct_returns(self) -> DataFrame:
        """M4: one row per return; a projection of the line fact's matched returns."""
        return self.returned_lines(self.fact)

    @staticmethod
    def returned_lines(fact: DataFrame) -> DataFrame:
        """M4 of some lines of the line fact."""
        f = fact.filter(F.col("_has_return"))
        restocked = F.col("_r_restocked")
        return f.select(
            "return_id", "order_item_id", "order_id", "customer_id", "product_id",
            "order_date", "order_month", "return_date",
            day_diff("order_date", "return_date").alias("days_to_return"),
            "category", "subcategory", "brand", "order_channel", "fulfilment_centre", "carrier",
            "is_on_time", "return_reason",
            restocked.alias("is_restocked"),
            F.when(restocked, F.lit("Recovered")).otherwise(F.lit("Written off")).alias("disposition"),
            F.col("_r_quantity").alias("quantity_returned"),
            F.col("quantity").alias("quantity_ordered"),
            F.col("_r_refund").alias("refund_amount"),
            money(to_double("_r_refund")
                  - F.when(restocked, to_double("cogs_recovered")).otherwise(F.lit(0.0)))
            .alias("margin_lost"),
        )

    @cached_property
    def fct_fulfilment_daily(self) -> DataFrame:
        """M5: shipped and delivered orders by order date x centre x carrier."""
        shared = self.materialise or "order_rollup" in self.__dict__  # stored for other marts anyway
        value = self.order_rollup if shared else self._order_rollup()
        value = value.select("order_id", F.col("net_revenue").alias("_net"),
                             F.col("contribution_margin").alias("_cm"))
        o = (self.orders
             .filter(F.col("is_shipped") & F.col("delivered_date").isNotNull())
             .join(value, "order_id"))
        on_time = F.col("is_on_time")
        return o.groupBy("order_date", "order_month", "fulfilment_centre", "carrier").agg(
            F.count(F.lit(1)).alias("orders"),
            F.count_if(on_time).alias("on_time_orders"),
            F.count_if(~F.coalesce(on_time, F.lit(False))).alias("late_orders"),
            F.count_if(F.col("days_late") >= 3).alias("badly_late_orders"),
            F.sum("days_late").alias("days_late_total"),
            round_half(exact_avg("days_late"), 3).alias("avg_days_late"),
            round_half(exact_avg("days_to_deliver"), 3).alias("avg_days_to_deliver"),
            round_half(exact_avg("transit_days"), 3).alias("avg_transit_days"),
            _msum("shipping_cost").alias("shipping_cost"),
            _msum("shipping_fee_charged").alias("shipping_fee_charged"),
            F.sum(F.col("shipping_cost") - F.col("shipping_fee_charged")).cast(MONEY_SUM)
            .alias("net_shipping_cost"),
            _msum("_net").alias("net_revenue"),
            _msum("_cm").alias("contribution_margin"),
            F.sum(F.when(on_time, F.lit(0).cast(MONEY_SUM)).otherwise(F.col("_net")))
            .cast(MONEY_SUM).alias("late_net_revenue"),
        ).select(*MART_COLUMNS["fct_fulfilment_daily"])

    @cached_property
    def fct_discount_bands(self) -> DataFrame:
        """M6: order month x category x discount band."""
        f = self.fct_order_items
        units = F.sum("quantity").cast("long")
        return f.groupBy("order_month", "category", "discount_band", "discount_band_rank").agg(
            F.count(F.lit(1)).alias("order_lines"),
            F.countDistinct("order_id").alias("orders"),
            units.alias("units"),
            round_half(exact_avg("quantity"), 3).alias("units_per_line"),
            _msum("gross_revenue").alias("gross_revenue"),
            _msum("discount_amount").alias("discount_given"),
            _msum("net_revenue").alias("net_revenue"),
            _msum("contribution_margin").alias("contribution_margin"),
            round_half(exact_avg("discount_rate"), 4).alias("avg_discount_rate"),
            ratio(F.sum("net_revenue"), units, 2).alias("net_revenue_per_unit"),
            ratio(F.sum("contribution_margin"), units, 2).alias("margin_per_unit"),
            ratio(F.sum("contribution_margin"), F.sum("net_revenue"), 4)
            .alias("contribution_margin_rate"),
            F.count_if(F.col("is_returned")).alias("returned_lines"),
            ratio(F.count_if(F.col("is_returned")), F.count(F.lit(1)), 4).alias("return_line_rate"),
        )

    # ------------------------------------------------------------- cohorts
    @cached_property
    def customer_month(self) -> DataFrame:
        """Activity pre-aggregated to (customer, month) before any cohort join, so a hot
        customer contributes one row per month to the shuffle that follows."""
        r = self.order_rollup.filter(F.col("_customer_known"))
        months = r.groupBy("customer_id", "order_month").agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("net_revenue").alias("net_revenue"),
            F.sum("contribution_margin").alias("contribution_margin"),
        )
        return self._colocate(months, "customer_month", "customer_id")

    @cached_property
    def repeat_members(self) -> DataFrame:
        """Customers with a first order, pinned to cohort month and experience. These are
        the dim_customer rows with a cohort (one dim row per staged customer), taken
        from their sources so the lifetime aggregate is not planned."""
        cfo = self.customer_first_order.select(
            "customer_id", "cohort_month", "first_order_experience")
        return (self.customers.select("customer_id").join(cfo, "customer_id")
                .filter(F.col("cohort_month").isNotNull()))

    @cached_property
    def repeat_cohort_size(self) -> DataFrame:
        """G1 for M7."""
        return G.cohort_size(self.repeat_members, ["cohort_month", "first_order_experience"])

    @cached_property
    def repeat_activity(self) -> DataFrame:
        """G2 for M7: active customers, orders, revenue and margin per cohort x month."""
        a = self.customer_month.join(self.repeat_members, "customer_id")
        return a.groupBy("cohort_month", "first_order_experience", "order_month").agg(
            F.count(F.lit(1)).alias("active_customers"),
            F.sum("orders").alias("orders"),
            F.sum("net_revenue").cast(MONEY_SUM).alias("net_revenue"),
            F.sum("contribution_margin").cast(MONEY_SUM).alias("contribution_margin"),
        )

    @cached_property
    def repeat_grid(self) -> DataFrame:
        """G3 for M7."""
        return G.dense_grid(self.repeat_cohort_size, "cohort_month", self.bounds)

    @cached_property
    def fct_cohort_repeat(self) -> DataFrame:
        """M7."""
        keys = ["cohort_month", "first_order_experience"]
        g = G.zero_fill(self.repeat_grid, self.repeat_activity, keys, "activity_month",
                        "order_month", ["active_customers", "orders", "net_revenue",
                                        "contribution_margin"])
        cum = G.running_total("contribution_margin", keys, "period_index")
        return g.select(
            "cohort_month", "first_order_experience", "activity_month", "period_index",
            "cohort_customers", "active_customers", "orders", "net_revenue",
            "contribution_margin",
            ratio("active_customers", "cohort_customers", 4).alias("active_rate"),
            cum.cast(MONEY_SUM).alias("cumulative_contribution_margin"),
            ratio(cum, F.col("cohort_customers"), 2).alias("cumulative_margin_per_customer"),
        )

    @cached_property
    def signup_members(self) -> DataFrame:
        """Signup cohort of every customer (the dim_customer columns come straight from
        the staged customers, one dim row per customer)."""
        return self.customers.select("customer_id", "acquisition_channel", "signup_month")

    @cached_property
    def payback_cohort_size(self) -> DataFrame:
        """G1 for M8: signup cohorts, never-ordered customers included."""
        return G.cohort_size(self.signup_members, ["acquisition_channel", "signup_month"])

    @cached_property
    def spend_by_month(self) -> DataFrame:
        """Spend rolled up per channel x month."""
        return self.stg.marketing_spend.groupBy("acquisition_channel", "spend_month").agg(
            _msum("spend").alias("acquisition_spend"))

    @cached_property
    def channel_cac(self) -> DataFrame:
        """Cohort with its acquisition spend and CAC."""
        s = self.spend_by_month.withColumnRenamed("spend_month", "signup_month")
        c = self.payback_cohort_size.join(s, ["acquisition_channel", "signup_month"], "left")
        spend = F.coalesce(F.col("acquisition_spend"), F.lit(0).cast(MONEY_SUM))
        return c.select(
            "acquisition_channel", "signup_month", "cohort_customers",
            spend.alias("acquisition_spend"),
            ratio(spend, F.col("cohort_customers"), 2).alias("cac"),
        )

    @cached_property
    def payback_activity(self) -> DataFrame:
        """G2 for M8."""
        a = self.customer_month.join(self.signup_members, "customer_id")
        return a.groupBy("acquisition_channel", "signup_month", "order_month").agg(
            F.count(F.lit(1)).alias("active_customers"),
            F.sum("net_revenue").cast(MONEY_SUM).alias("net_revenue"),
            F.sum("contribution_margin").cast(MONEY_SUM).alias("contribution_margin"),
        )

    @cached_property
    def fct_channel_payback(self) -> DataFrame:
        """M8."""
        keys = ["acquisition_channel", "signup_month"]
        grid = G.dense_grid(self.channel_cac, "signup_month", self.bounds)
        g = G.zero_fill(grid, self.payback_activity, keys, "activity_month", "order_month",
                        ["active_customers", "net_revenue", "contribution_margin"])
        cum = G.running_total("contribution_margin", keys, "period_index").cast(MONEY_SUM)
        return g.select(
            "acquisition_channel", "signup_month", "activity_month", "period_index",
            "cohort_customers", "acquisition_spend", "cac", "active_customers", "net_revenue",
            "contribution_margin",
            cum.alias("cumulative_contribution_margin"),
            (cum - F.col("acquisition_spend")).cast(MONEY_SUM).alias("cumulative_margin_net_of_cac"),
            ratio(cum, F.col("acquisition_spend"), 4).alias("payback_ratio"),
        )

    # ------------------------------------------------------------------ all
    @cached_property
    def kept(self) -> "MartBuild":
        """This build with its shared intermediates stored: for checks that compare a few
        marts, each then a short plan over the stored line fact or rollup."""
        if self.materialise:
            return self
        from ledgerwalk.session import run_folder

        return MartBuild(self.src, self.band_edges, materialise=True,
                         folder=run_folder(self.spark, "build"))

    @cached_property
    def light(self) -> "MartBuild":
        """This build without any stored intermediate, for a check of a few columns; a build that has
        stored some already reads those."""
        if self.materialise or self._stored is not None:
            return self
        return MartBuild(self.src, self.band_edges, fact_path=self.fact_path, store_rollup=False)

    @property
    def has_stored(self) -> bool:
        """Whether ``stored`` has its marts already."""
        return self._stored is not None

    def stored(self) -> dict[str, DataFrame]:
        """All marts, written once from ``kept`` and read again: for checks of every mart. Where
        nothing else has asked for the kept intermediates, they are dropped when the marts stand."""
        if self._stored is None:
            from ledgerwalk.session import drop_folder, run_folder

            own = not self.materialise and "kept" not in self.__dict__
            kept = _ForMarts(self.src, self.band_edges, materialise=True,
                             folder=run_folder(self.spark, "build")) if own else self.kept
            paths = kept.write_marts(run_folder(self.spark, "marts"))
            if own:
                drop_folder(self.spark, kept.folder)
            self._stored = {m: self.spark.read.parquet(path) for m, path in paths.items()}
        return self._stored

    def marts(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in MART_COLUMNS}

    def _written(self, folder: str) -> None:
        """``folder``, a slice of the stored line fact, has given its last copy."""

    def write_marts(self, folder: str, fmt: str = "parquet", parallel: int = 8) -> dict[str, str]:
        """Store every mart under ``folder``.

        Marts that read the line fact alone are submitted as soon as they are planned, so
        that their jobs run while the order roll-up is stored and the others are planned;
        all writes are concurrent Spark jobs, so small marts do not leave the cluster idle.
        Plans are made in the calling thread. Where the line fact comes in slices, so that a
        single write fills the cluster and its disks, the writes go one after the other, and
        copies of lines, which shuffle nothing, last and slice by slice.
        """
        import os
        from concurrent.futures import ThreadPoolExecutor

        from ledgerwalk.session import COMPACT, freed_shuffles

        def write(name: str, df: DataFrame, mode: str = "overwrite") -> str:
            path = os.path.join(folder, name)
            df.write.mode(mode).format(fmt).options(**(COMPACT if fmt == "parquet" else {})).save(path)
            return path

        if self.materialise and self.slices > 1 and self.fact is not None and self.fact_folders:
            copies = {"fct_order_items": self.published_lines, "fct_returns": self.returned_lines}
            with freed_shuffles(self.spark):
                for name in MART_COLUMNS:
                    if name not in copies:
                        write(name, getattr(self, name))
                for k, at in enumerate(self.fact_folders):
                    part = self.spark.read.parquet(at)
                    for name, lines in copies.items():
                        write(name, lines(part), "append" if k else "overwrite")
                    self._written(at)
            return {name: os.path.join(folder, name) for name in MART_COLUMNS}
        of_lines = ["fct_order_items", "fct_returns", "dim_product", "fct_discount_bands"]
        with freed_shuffles(self.spark), ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            jobs = {name: pool.submit(write, name, getattr(self, name))
                    for name in [*of_lines, *(m for m in MART_COLUMNS if m not in of_lines)]}
            return {name: jobs[name].result() for name in MART_COLUMNS}


class _ForMarts(MartBuild):
    """A build of the eight marts alone: of the line fact, the columns that no mart reads aren't stored,
    and a slice goes when its lines have been copied."""

    def _written(self, folder: str) -> None:
        from ledgerwalk.session import drop_folder

        drop_folder(self.spark, folder)

    @staticmethod
    def fact_shape(fact: DataFrame) -> DataFrame:
        return fact.drop("promo_code", "weight_kg", "cogs_gross", "shipping_cost_allocated",
                         "shipping_fee_allocated", "_unit_cost", "_freight")


class ForOrders(_ForMarts):
    """A build of the marts of orders and customers: of the line fact, what the order roll-up adds up."""

    @staticmethod
    def fact_shape(fact: DataFrame) -> DataFrame:
        return fact.select("order_id", "customer_id", "order_date", "order_month", "_customer_known", "quantity", "net_revenue",
                           "realised_revenue", "contribution_margin", "refund_amount", "is_returned")
