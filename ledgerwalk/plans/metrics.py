"""Metric layer K101-K702: aggregate-then-divide measures over the marts.

``evaluate(df, dataset, dims, metrics, filters, params)`` is one
``filter -> groupBy(dims) -> agg`` plan (partial + final aggregation). Rates are
always SUM(num) / SUM(den), never a mean of row rates; zero denominators give
NULL. Semi-additive measures (cohort sizes, spend and running totals repeat on
every period row) are refused unless ``period_index`` is grouped or fixed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerwalk.functions.numeric import MONEY_SUM, ratio as _div


def _s(c: str) -> Column:
    return F.sum(F.col(c))


@dataclass(frozen=True)
class Metric:
    id: str
    dataset: str
    name: str
    kind: str  # additive | ratio | non-additive | semi-additive | share
    build: Callable[[dict], Column]


# The parameter value that selects contribution margin in K108.
MARGIN_BASIS_DEFAULT = "Contribution Margin"

# The 26 published measure formulas.
_M = [
    Metric("K101", "fct_order_items", "contribution_margin_rate", "ratio",
           lambda p: _div(_s("contribution_margin"), _s("net_revenue"))),
    Metric("K102", "fct_order_items", "average_order_value", "non-additive",
           lambda p: _div(_s("net_revenue"), F.countDistinct("order_id"))),
    Metric("K103", "fct_order_items", "margin_per_order", "non-additive",
           lambda p: _div(_s("contribution_margin"), F.countDistinct("order_id"))),
    Metric("K104", "fct_order_items", "return_line_rate", "ratio",
           lambda p: _div(F.count_if(F.col("is_returned")), F.count("order_item_id"))),
    Metric("K105", "fct_order_items", "freight_pct_revenue", "ratio",
           lambda p: _div(_s("net_shipping_cost"), _s("net_revenue"))),
    Metric("K106", "fct_order_items", "discount_pct_gross", "ratio",
           lambda p: _div(_s("discount_amount"), _s("gross_revenue"))),
    Metric("K107", "fct_order_items", "category_contribution_share", "share",
           lambda p: _s("contribution_margin")),
    Metric("K108", "fct_order_items", "margin_basis", "additive",
           lambda p: (_s("contribution_margin")
                      if p.get("margin_basis", MARGIN_BASIS_DEFAULT) == MARGIN_BASIS_DEFAULT
                      else _s("net_revenue")).cast(MONEY_SUM)),
    Metric("K201", "fct_fulfilment_daily", "on_time_rate", "ratio",
           lambda p: _div(_s("on_time_orders"), _s("orders"))),
    Metric("K202", "fct_fulfilment_daily", "average_days_late", "ratio",
           lambda p: _div(_s("days_late_total"), _s("orders"))),
    Metric("K203", "fct_fulfilment_daily", "revenue_on_late_parcels", "additive",
           lambda p: _s("late_net_revenue").cast(MONEY_SUM)),
    Metric("K204", "fct_fulfilment_daily", "late_revenue_share", "ratio",
           lambda p: _div(_s("late_net_revenue"), _s("net_revenue"))),
    Metric("K205", "fct_fulfilment_daily", "freight_subsidy_per_order", "ratio",
           lambda p: _div(_s("net_shipping_cost"), _s("orders"))),
    Metric("K301", "fct_discount_bands", "margin_per_unit", "ratio",
           lambda p: _div(_s("contribution_margin"), _s("units"))),
    Metric("K302", "fct_discount_bands", "net_revenue_per_unit", "ratio",
           lambda p: _div(_s("net_revenue"), _s("units"))),
    Metric("K303", "fct_discount_bands", "contribution_margin_rate", "ratio",
           lambda p: _div(_s("contribution_margin"), _s("net_revenue"))),
    Metric("K304", "fct_discount_bands", "units_per_line", "ratio",
           lambda p: _div(_s("units"), _s("order_lines"))),
    Metric("K401", "fct_cohort_repeat", "repeat_rate", "semi-additive",
           lambda p: _div(_s("active_customers"), _s("cohort_customers"))),
    Metric("K402", "fct_cohort_repeat", "cumulative_margin_per_customer", "semi-additive",
           lambda p: _div(_s("cumulative_contribution_margin"), _s("cohort_customers"))),
    Metric("K501", "fct_channel_payback", "cac", "semi-additive",
           lambda p: _div(_s("acquisition_spend"), _s("cohort_customers"))),
    Metric("K502", "fct_channel_payback", "margin_net_of_cac_per_customer", "semi-additive",
           lambda p: _div(_s("cumulative_margin_net_of_cac"), _s("cohort_customers"))),
    Metric("K503", "fct_channel_payback", "payback_multiple", "semi-additive",
           lambda p: _div(_s("cumulative_contribution_margin"), _s("acquisition_spend"))),
    Metric("K601", "fct_returns", "margin_lost", "additive",
           lambda p: _s("margin_lost").cast(MONEY_SUM)),
    Metric("K602", "fct_returns", "write_off_share", "ratio",
           lambda p: _div(F.sum(F.when(F.col("is_restocked"), F.lit(0))
                                .otherwise(F.col("margin_lost"))), _s("margin_lost"))),
    Metric("K701", "dim_product", "realised_margin_rate", "ratio",
           lambda p: _div(_s("contribution_margin"), _s("net_revenue"))),
    Metric("K702", "dim_product", "margin_gap_vs_list", "ratio",
           lambda p: _div(_s("contribution_margin"), _s("net_revenue"))
           - _div(_s("list_margin_rate"), F.count("list_margin_rate"))),
]

METRICS: dict[str, Metric] = {m.id: m for m in _M}
BY_NAME: dict[tuple[str, str], Metric] = {(m.dataset, m.name): m for m in _M}

# Numeric columns that label rather than measure - never summed.
DIMENSION_OVERRIDES = {
    "fct_order_items": ["order_sequence", "discount_band_rank", "days_late"],
    "fct_discount_bands": ["discount_band_rank"],
    "fct_cohort_repeat": ["period_index"],
    "fct_channel_payback": ["period_index"],
    "fct_returns": ["quantity_ordered"],
}


def metric(ref: str, dataset: str | None = None) -> Metric:
    if ref in METRICS:
        return METRICS[ref]
    for (ds, name), m in BY_NAME.items():
        if name == ref and (dataset is None or ds == dataset):
            return m
    raise KeyError(f"unknown metric {ref!r}")


def summable(dataset: str, column: str) -> bool:
    """A column may be summed unless it is declared a dimension."""
    return column not in DIMENSION_OVERRIDES.get(dataset, [])


def evaluate(df: DataFrame, dataset: str, dims: list, metrics: list[str],
             filters: list[Column] | None = None, params: dict | None = None,
             period: int | None = None, sums: list[str] | None = None) -> DataFrame:
    """Filter, group by ``dims`` and compute the named metrics (aliased by name).

    ``period``: fix ``period_index`` at this value, which a semi-additive metric needs
    where the period isn't grouped. ``sums``: plain columns to sum beside the metrics;
    columns that label rather than measure are refused.
    """
    params = params or {}
    _refuse(dataset, metrics, sums or [], [d for d in dims if isinstance(d, str)], period)
    if period is not None:
        df = df.filter(F.col("period_index") == period)
    ms = [metric(r, dataset) for r in metrics]
    for f in filters or []:
        df = df.filter(f)
    grouped = df.groupBy(*dims) if dims else df.groupBy()
    out = grouped.agg(*[m.build(params).alias(m.name) for m in ms],
                      *[F.sum(c).alias(c) for c in sums or []])
    return _shares(out, ms)


def _refuse(dataset: str, metrics, sums, dims, period: int | None) -> None:
    """What no answer may do: sum a column that labels, use a metric of another dataset, or add a
    semi-additive metric up over periods."""
    for c in sums:
        if not summable(dataset, c):
            raise ValueError(f"{dataset}.{c} is a dimension and is never summed")
    ms = [metric(r, dataset) for r in metrics]
    for m in ms:
        if m.dataset != dataset:
            raise ValueError(f"{m.id} is defined on {m.dataset}, not {dataset}")
    if any(m.kind == "semi-additive" for m in ms) and "period_index" not in dims and period is None:
        raise ValueError("semi-additive metrics need period_index grouped or fixed")


def _shares(out: DataFrame, ms: list[Metric]) -> DataFrame:
    """Shares of the total: a window over the aggregated rows only."""
    shares = [m for m in ms if m.kind == "share"]
    total = Window.partitionBy()
    return out.withColumns({m.name: _div(F.col(m.name), F.sum(m.name).over(total)) for m in shares}) if shares else out


@dataclass(frozen=True)
class Request:
    """One question to a dataset: metrics by ``dims`` under ``filters``, as ``evaluate`` takes them."""

    name: str
    dims: tuple[str, ...]
    metrics: tuple[str, ...]
    filters: tuple[Column, ...] = ()
    period: int | None = None
    sums: tuple[str, ...] = ()


def evaluate_shared(df: DataFrame, dataset: str, requests: list[Request], params: dict | None = None,
                    folder: str | None = None) -> dict[str, DataFrame]:
    """Answer several requests on one dataset from a single scan of it.

    Each request is a grouping set: its dimensions and, where it filters, its filter as a flag,
    of which only the true half is kept; rows that no request wants are left out before.
    Requests with equal dimensions and filters share a set. ``grouping_id`` says which
    set an aggregated row belongs to. The aggregate, as small as its answers, is stored, and
    the answers are read from it: the columns that ``evaluate`` gives, by name of request.
    The rules of ``evaluate`` on semi-additive metrics and on columns that label hold.
    """
    from ledgerwalk.session import run_folder
    from ledgerwalk.sources.publish import materialise_frame

    params = params or {}
    asked: dict[str, Column] = {}
    sets: list[list[str]] = []
    flags: list[Column | None] = []
    flagged: dict[str, Column] = {}
    of_request: list[int] = []
    for r in requests:
        _refuse(dataset, r.metrics, r.sums, r.dims, r.period)
        asked.update({metric(m, dataset).id: metric(m, dataset).build(params) for m in r.metrics})
        asked.update({f"sum({c})": F.sum(c) for c in r.sums})
        conditions = [*r.filters, *([F.col("period_index") == r.period] if r.period is not None else [])]
        flag, group = None, list(r.dims)
        if conditions:
            both = conditions[0]
            for c in conditions[1:]:
                both = both & c
            flag = F.coalesce(both, F.lit(False))
            key = next((k for k, c in flagged.items() if str(c) == str(flag)), f"_wanted{len(flagged)}")
            flagged[key] = flag
            group.append(key)
        if sorted(group) not in [sorted(x) for x in sets]:
            sets.append(group)
            flags.append(flag)
        of_request.append(next(i for i, x in enumerate(sets) if sorted(x) == sorted(group)))

    if all(f is not None for f in flags):
        wanted = flags[0]
        for f in flags[1:]:
            wanted = wanted | f
        df = df.where(wanted)
    cols = list(dict.fromkeys(c for x in sets for c in x))
    shared = df.withColumns(flagged) if flagged else df
    columns = [F.col(c) for c in cols]
    shared = shared.groupingSets([[F.col(c) for c in x] for x in sets], *columns).agg(
        F.grouping_id().alias("_set"), *[c.alias(k) for k, c in asked.items()])
    shared = materialise_frame(shared, folder or run_folder(df.sparkSession, "shared-scan"), "answers")

    out = {}
    for r, i in zip(requests, of_request):
        bits = sum(1 << (len(cols) - 1 - k) for k, c in enumerate(cols) if c not in sets[i])
        rows = shared.where(F.col("_set") == bits)
        for c in sets[i]:
            if c in flagged:
                rows = rows.where(F.col(c))
        rows = rows.select(*r.dims, *[F.col(f"`{metric(m, dataset).id}`").alias(metric(m, dataset).name) for m in r.metrics],
                           *[F.col(f"`sum({c})`").alias(c) for c in r.sums])
        out[r.name] = _shares(rows, [metric(m, dataset) for m in r.metrics])
    return out


def in_range(col: str, lo, hi) -> Column:
    """Inclusive range filter."""
    return F.col(col).between(lo, hi)


def member_of(col: str, members) -> Column:
    """Member (IN-list) filter."""
    return F.col(col).isin(list(members))
