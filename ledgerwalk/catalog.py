"""Registered queries: name -> function(MartBuild) -> DataFrame.

Every query reads the bound source tables through one :class:`MartBuild`, so its
work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ledgerwalk.plans.economics import order_item_economics
from ledgerwalk.plans.marts import MartBuild

QUERIES: dict[str, Callable[[MartBuild], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _attr(name: str, attr: str | None = None):
    QUERIES[name] = lambda b, a=(attr or name): getattr(b, a)


# P1-P6
for _n in ["customers", "products", "orders", "order_items", "returns", "marketing_spend"]:
    QUERIES[f"stg_{_n}"] = (lambda b, n=_n: getattr(b.stg, n))

# I*
_attr("basket_allocation")
QUERIES["order_item_economics"] = lambda b: b.in_slices(order_item_economics)
_attr("month_spine")
_attr("first_order_per_customer", "first_orders")
_attr("customer_first_order")


@register("order_rollup")
def _order_rollup(b: MartBuild) -> DataFrame:
    return b.order_rollup.select("order_id", "had_return", "net_revenue", "contribution_margin")


# M*
for _m in ["dim_customer", "dim_product", "fct_order_items", "fct_returns",
           "fct_fulfilment_daily", "fct_discount_bands", "fct_cohort_repeat",
           "fct_channel_payback"]:
    _attr(_m)
QUERIES["fct_order_items"] = lambda b: b.in_slices(b.published_lines)

# G*
_attr("cohort_size", "repeat_cohort_size")
_attr("cohort_activity", "repeat_activity")
_attr("channel_cac")


@register("dense_grid")
def _dense_grid(b: MartBuild) -> DataFrame:
    return b.repeat_grid.select("cohort_month", "first_order_experience", "cohort_customers",
                                "activity_month", "period_index")


@register("running_margin")
def _running_margin(b: MartBuild) -> DataFrame:
    return b.fct_cohort_repeat.select(
        "cohort_month", "first_order_experience", "period_index",
        "cumulative_contribution_margin", "cumulative_margin_per_customer")


# K*: every metric of each dataset, at a natural grain
from ledgerwalk.plans import analyses as A  # noqa: E402
from ledgerwalk.plans.metrics import evaluate  # noqa: E402

_METRIC_QUERIES = {
    "metrics_order_lines": ("fct_order_items", ["category"],
                            ["K101", "K102", "K103", "K104", "K105", "K106", "K107", "K108"]),
    "metrics_fulfilment": ("fct_fulfilment_daily", ["fulfilment_centre", "carrier"],
                           ["K201", "K202", "K203", "K204", "K205"]),
    "metrics_discount": ("fct_discount_bands", ["category", "discount_band_rank", "discount_band"],
                         ["K301", "K302", "K303", "K304"]),
    "metrics_cohort": ("fct_cohort_repeat", ["first_order_experience", "period_index"],
                       ["K401", "K402"]),
    "metrics_payback": ("fct_channel_payback", ["acquisition_channel", "period_index"],
                        ["K501", "K502", "K503"]),
    "metrics_returns": ("fct_returns", ["return_reason"], ["K601", "K602"]),
    "metrics_product": ("dim_product", ["category"], ["K701", "K702"]),
}
for _q, (_ds, _dims, _ms) in _METRIC_QUERIES.items():
    QUERIES[_q] = (lambda b, ds=_ds, dims=_dims, ms=_ms: evaluate(getattr(b, ds), ds, dims, ms))

# V*, A*
QUERIES["sheet_01_net_revenue"] = lambda b: A.sheet_01(b, margin_basis="Net Revenue")
for _i in range(1, 11):
    QUERIES[f"sheet_{_i:02d}"] = getattr(A, f"sheet_{_i:02d}")
for _a in ["answer_q1", "answer_q2", "answer_q3", "answer_q3_weekly", "answer_q4", "answer_q5",
           "answer_breakeven", "answer_q6", "answer_return_products", "headline_kpis"]:
    QUERIES[_a] = getattr(A, _a)

# C*
from ledgerwalk.plans import checks as C  # noqa: E402

QUERIES.update(C.CONTRACTS)
QUERIES["mart_fingerprint"] = C.c27_fingerprints
QUERIES["schema_contract"] = C.c28_schema_contract
QUERIES["published_order"] = C.published_order

# G* on the second domain
from ledgerwalk.plans.events import events_daily_cohort  # noqa: E402

QUERIES["events_daily_cohort"] = lambda b: events_daily_cohort(
    b.spark.read.parquet(f"{b.src.sf_dir}/events.parquet"))


# distinct counts that merge, delta maintenance, co-located storage, shared scans, filters
from ledgerwalk.plans import deltas as D  # noqa: E402

QUERIES["order_values_by_quarter"] = D.order_values_by_quarter
QUERIES["restated_marts"] = D.restated_marts
QUERIES["colocated_marts"] = D.colocated_marts
from ledgerwalk.plans.asof import as_of_summary, payback_by_month_end, repeat_rates_by_month_end  # noqa: E402
from ledgerwalk.plans.ledger import resumed_build  # noqa: E402

QUERIES["as_of_summary"] = as_of_summary
QUERIES["as_of_repeat_rates"] = repeat_rates_by_month_end
QUERIES["as_of_payback"] = payback_by_month_end
QUERIES["resumed_build"] = resumed_build
QUERIES["contract_c27_buckets"] = C.c27_buckets
QUERIES["shared_order_lines"] = A.shared_order_lines
QUERIES["sheet_06_matrix"] = A.sheet_06_matrix
QUERIES["lanes_of_two_centres"] = lambda b: A.lanes_of(b, ("ASIA", "EUROPE"), ("Carrier 0", "Carrier 2"))


@register("quarantine_counts")
def _quarantine_counts(b: MartBuild) -> DataFrame:
    """S1 + X9: text extracts with broken dates, numbers and lines; what is held back and what is read."""
    from pyspark.sql import functions as F

    from ledgerwalk.session import run_folder
    from ledgerwalk.sources.binding import store_as_broken_text
    from ledgerwalk.sources.contracts import SOURCE_NAMES
    from ledgerwalk.sources.extracts import quarantine_extracts

    folder = run_folder(b.spark, "broken-extracts")
    store_as_broken_text(b.src, folder)
    src, held = quarantine_extracts(b.spark, folder, run_folder(b.spark, "quarantine"))
    out = held.groupBy("source", "column", "reason").agg(F.count(F.lit(1)).alias("rows"))
    for n in SOURCE_NAMES:
        out = out.unionAll(getattr(src, n).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(n).alias("source"), F.lit(None).cast("string").alias("column"), F.lit("sound").alias("reason"), "rows"))
    return out


# T8 option
from ledgerwalk.plans.economics import exact_freight_allocation  # noqa: E402

QUERIES["freight_allocation_exact"] = lambda b: exact_freight_allocation(b.stg, b.orders)


@register("source_report")
def _source_report(b: MartBuild) -> DataFrame:
    """S2 + S3: the registry of the six extracts, written as text."""
    from ledgerwalk.session import run_folder
    from ledgerwalk.sources.binding import store_as_text
    from ledgerwalk.sources.extracts import source_report

    folder = run_folder(b.spark, "text-extracts")
    store_as_text(b.src, folder)
    return source_report(b.spark, folder)


@register("order_items_from_text")
def _order_items_from_text(b: MartBuild) -> DataFrame:
    """S1 and the published band edges: the line fact from all-string CSV extracts."""
    from ledgerwalk.session import run_folder
    from ledgerwalk.sources.binding import store_as_text

    text = store_as_text(b.src, run_folder(b.spark, "text-extracts"))
    text = MartBuild(text)
    return text.in_slices(text.published_lines)
