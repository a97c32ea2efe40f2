"""Hand-written fixtures for the margin walk and the marts (FIXTURES.md F1-F17)."""

from decimal import Decimal

import pytest

from builders import customer, item, order, product, raw_sources, ret, spend
from ledgerwalk.plans.marts import MartBuild

D = Decimal


@pytest.fixture(scope="module")
def build(spark):
    src = raw_sources(
        spark,
        customers=[customer("C1"), customer("C2", signup="2024-02-03", channel="Paid Social"),
                   customer("C9", signup="2024-01-20"),
                   customer("C3", signup="2023-11-10", channel="Affiliate"),
                   customer("C4", signup="2024-09-01", channel="Affiliate")],
        products=[product("P1", cost="4.00"), product("P2", cost="5.00"),
                  product("P3", cost="1.00"), product("PX", cost="1.00")],
        orders=[
            # F1: lines net 30 / 10, freight cost 8, fee 0 -> 6.00 / 2.00
            order("O1", "C1", date="2024-01-10", cost="8.00"),
            # two fully discounted lines -> even split
            order("O2", "C1", date="2024-03-05", seq=2, promised="2024-03-08",
                  ship_date="2024-03-06", delivered="2024-03-11", cost="4.00"),
            # three equal lines, cost 10.00 -> 3.33 each
            order("O3", "C2", date="2024-02-10", cost="10.00", delivered="2024-02-12",
                  promised="2024-02-12"),
            # store pick-up
            order("O4", "C2", date="2024-02-10", seq=2, shipped=False),
            # same customer, same day: smaller order id first
            order("O6", "C3", date="2024-01-15", promised="2024-01-15", delivered="2024-01-18"),
            order("O5", "C3", date="2024-01-15", seq=2),
        ],
        order_items=[
            item("I1", "O1", "P1", qty=1, price="30.00"),
            item("I2", "O1", "P1", qty=1, price="10.00"),
            item("I3", "O2", "P2", qty=2, price="5.00", discount="10.00"),
            item("I4", "O2", "P2", qty=1, price="5.00", discount="5.00"),
            item("I5", "O3", "P3", qty=1, price="10.00"),
            item("I6", "O3", "P3", qty=1, price="10.00"),
            item("I7", "O3", "P3", qty=1, price="10.00"),
            # Qty 2, cost 5, net 20; one unit back, refund 10
            item("I8", "O4", "P2", qty=2, price="10.00"),
            item("I9", "O6", "P2", qty=2, price="10.00"),
            item("I10", "O5", "P3", qty=1, price="10.00"),
        ],
        returns=[ret("R1", "I8", date="2024-02-15", restocked=True),
                 ret("R2", "I9", date="2024-01-25", restocked=False, reason="Damaged")],
        marketing_spend=[spend("2024-01-07", "Organic Search", "50.00"),
                         spend("2024-02-07", "Paid Social", "0.00")],
    )
    return MartBuild(src)


def _by(df, key):
    return {r[key]: r for r in df.collect()}


def test_freight_allocation_by_share_and_fallback(build):
    e = _by(build.economics, "order_item_id")
    assert e["I1"]["net_shipping_cost"] == D("6.00") and e["I2"]["net_shipping_cost"] == D("2.00")
    assert e["I3"]["net_shipping_cost"] == D("2.00") and e["I4"]["net_shipping_cost"] == D("2.00")
    assert [e[i]["net_shipping_cost"] for i in ("I5", "I6", "I7")] == [D("3.33")] * 3
    shares = _by(build.basket_allocation, "order_item_id")
    assert shares["I3"]["revenue_share"] == 0.5 and shares["I1"]["revenue_share"] == 0.75


def test_cogs_recovery_and_margin_lost(build):
    e = _by(build.economics, "order_item_id")
    assert (e["I8"]["cogs_gross"], e["I8"]["cogs_recovered"], e["I8"]["cogs_net"]) == \
        (D("10.00"), D("5.00"), D("5.00"))
    assert e["I8"]["realised_revenue"] == D("10.00")
    assert (e["I9"]["cogs_recovered"], e["I9"]["cogs_net"]) == (D("0.00"), D("10.00"))
    r = _by(build.fct_returns, "return_id")
    assert r["R1"]["margin_lost"] == D("5.00") and r["R1"]["disposition"] == "Recovered"
    assert r["R2"]["margin_lost"] == D("10.00") and r["R2"]["disposition"] == "Written off"


def test_store_pickup_delivery_columns(build):
    o = _by(build.stg.orders, "order_id")["O4"]
    assert o["days_late"] == 0
    assert o["transit_days"] is None and o["days_to_deliver"] is None and o["is_on_time"] is None
    lanes = {r["fulfilment_centre"] for r in build.fct_fulfilment_daily.collect()}
    assert "Store Pickup" not in lanes


def test_days_late_and_on_time(build):
    o = _by(build.stg.orders, "order_id")
    assert (o["O1"]["is_on_time"], o["O1"]["days_late"]) == (True, 0)
    assert (o["O3"]["is_on_time"], o["O3"]["days_late"]) == (True, 0)
    assert (o["O2"]["is_on_time"], o["O2"]["days_late"]) == (False, 3)
    daily = build.fct_fulfilment_daily.collect()
    assert sum(r["badly_late_orders"] for r in daily) == 2  # O2 (3 days) and O6 (3 days)


def test_first_order_tie_break_and_experience(build):
    f = _by(build.customer_first_order, "customer_id")
    assert f["C3"]["first_order_id"] == "O5"
    # C2's first order (O3) is on time and not returned; O4 was the store pick-up
    assert f["C2"]["first_order_experience"] == "Clean"
    assert f["C1"]["first_order_experience"] == "Clean"


def test_never_ordered_customer(build):
    c = _by(build.dim_customer, "customer_id")["C9"]
    assert c["orders"] == 0 and c["lifetime_net_revenue"] == D("0.00")
    assert c["cohort_month"] is None and c["avg_order_value"] is None
    assert c["is_active"] is False and c["is_repeat_customer"] is False
    cohorts = {r["cohort_month"] for r in build.fct_cohort_repeat.collect()}
    assert None not in cohorts


def test_unsold_product(build):
    p = _by(build.dim_product, "product_id")["PX"]
    assert p["order_lines"] == 0 and p["net_revenue"] == D("0.00")
    assert p["avg_discount_rate"] is None and p["contribution_margin_rate"] is None


def test_dense_grid_and_running_total(build):
    rows = sorted((r for r in build.fct_cohort_repeat.collect()
                   if str(r["cohort_month"]) == "2024-01-01"
                   and r["first_order_experience"] == "Clean"), key=lambda r: r["period_index"])
    assert [r["period_index"] for r in rows] == [0, 1, 2]
    feb = rows[1]
    assert feb["active_customers"] == 0 and feb["contribution_margin"] == D("0.00")
    assert feb["cumulative_contribution_margin"] == rows[0]["cumulative_contribution_margin"]


def test_payback_spend_zero_and_missing(build):
    p = build.fct_channel_payback.collect()
    social = [r for r in p if r["acquisition_channel"] == "Paid Social"]
    assert social and all(r["payback_ratio"] is None for r in social)
    assert all(r["cac"] == 0.0 for r in social)
    # a signup before the first order month starts at the spine with index > 0;
    # a signup after the last order month has no rows
    aff = sorted((r for r in p if r["acquisition_channel"] == "Affiliate"),
                 key=lambda r: r["period_index"])
    assert aff[0]["period_index"] == 2 and str(aff[0]["activity_month"]) == "2024-01-01"
    assert all(str(r["signup_month"]) != "2024-09-01" for r in aff)


def test_contracts_pass_on_clean_fixture(build):
    from ledgerwalk.plans.checks import run_contracts

    bad = [r for r in run_contracts(build).collect() if not r["ok"]]
    assert bad == []


def test_exact_freight_allocation_reconciles_to_the_penny(build):
    from ledgerwalk.plans.economics import exact_freight_allocation

    rows = exact_freight_allocation(build.stg, build.orders).collect()
    o3 = sorted(r["net_shipping_cost_exact"] for r in rows if r["order_id"] == "O3")
    assert o3 == [D("3.33"), D("3.33"), D("3.34")]
    by_order = {}
    for r in rows:
        by_order.setdefault(r["order_id"], [D(0), r["freight_cents"]])
        by_order[r["order_id"]][0] += r["net_shipping_cost_exact"]
    assert all(total * 100 == cents for total, cents in by_order.values())
