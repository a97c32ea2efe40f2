"""Each contract reports violations on a deliberately broken input (F18), and mart
content does not depend on the shuffle partition count (F19, C27)."""

import pytest

from builders import customer, item, order, product, raw_sources, ret
from ledgerwalk.plans import checks as C
from ledgerwalk.plans.marts import MartBuild


@pytest.fixture(scope="module")
def broken(spark):
    src = raw_sources(
        spark,
        customers=[customer("C1"), customer("C1"), customer(None)],
        products=[product("P1")],
        orders=[order("O1", "C1", date="2024-01-10", delivered="2024-01-09"),
                order("O2", "C1", date="2024-01-11", shipped=False, promised="x")],
        order_items=[item("I1", "O1", "P1", qty=1, price="10.00"),
                     item("I2", "O1", "P1", qty=1, price="10.00")],
        returns=[ret("R1", "I1", date="2024-01-05", qty=3)],
    )
    return MartBuild(src)


def _violations(df):
    return sum(r["violations"] for r in df.collect())


def test_duplicate_and_null_keys(broken):
    assert _violations(C.c03_key_unique(broken)) >= 1
    assert _violations(C.c04_key_not_null(broken)) >= 1


def test_quantity_and_date_integrity(broken):
    assert _violations(C.c07_returned_le_ordered(broken)) >= 1
    assert _violations(C.c08_return_after_order(broken)) >= 1
    assert _violations(C.c09_delivery_ordered(broken)) >= 1


def test_orphans_are_reported(spark):
    src = raw_sources(
        spark,
        customers=[customer("C1")],
        products=[product("P1")],
        orders=[order("O1", "C1"), order("O2", "CX")],
        order_items=[item("I1", "O1", "P1"), item("I2", "O2", "P1")],
    )
    b = MartBuild(src)
    # line of an unknown customer: kept in the economics, dropped from the published fact
    assert b.economics.count() == 2 and b.fct_order_items.count() == 1
    agree = C.c22_net_revenue_agrees(b).collect()
    assert any(not r["ok"] for r in agree)


def test_fingerprint_independent_of_partitions(spark):
    from builders import customer as cu, item as it, order as od, product as pr

    src = raw_sources(
        spark,
        customers=[cu(f"C{i}") for i in range(20)],
        products=[pr(f"P{i}", cost=f"{i}.10") for i in range(5)],
        orders=[od(f"O{i}", f"C{i % 20}", date=f"2024-0{1 + i % 6}-1{i % 9}",
                   cost=f"{i % 7}.99") for i in range(60)],
        order_items=[it(f"I{i}", f"O{i % 60}", f"P{i % 5}", qty=1 + i % 3, price=f"{i}.33",
                        discount=f"{i % 4}.00") for i in range(150)],
    )
    prints = []
    for n in ("1", "7", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        prints.append(sorted(tuple(r) for r in C.c27_fingerprints(MartBuild(src)).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert prints[0] == prints[1] == prints[2]


def test_single_pass_reports_agree_with_individual_checks(broken):
    report = {(r["contract"], r["subject"]): r["violations"]
              for r in C.run_contracts(broken).collect()}
    for fn in (C.c07_returned_le_ordered, C.c11_band_boundaries, C.c19_cogs_recovery):
        for r in fn(broken).collect():
            assert report[(r["contract"], r["subject"])] == r["violations"]
    recon = {r["contract"]: r["gap"] for r in C.run_reconciliations(broken).collect()
             if r["contract"] in ("C15", "C16", "C17")}
    for fn in (C.c15_margin_identity, C.c16_realised_identity, C.c17_net_identity):
        r = fn(broken).collect()[0]
        assert recon[r["contract"]] == r["gap"]


# ---- every contract passes on a sound build and reports the one thing that is broken
@pytest.fixture(scope="module")
def sound(spark):
    from builders import spend

    src = raw_sources(
        spark,
        customers=[customer("C1"), customer("C2", signup="2024-01-20"), customer("C3")],
        products=[product("P1"), product("P2", cost="3.33", price="9.99")],
        orders=[order("O1", "C1", fee="2.00", cost="5.01"), order("O2", "C1", date="2024-02-10", seq=2,
                promised="2024-02-12", ship_date="2024-02-11", delivered="2024-02-15"),
                order("O3", "C2", date="2024-02-01", shipped=False)],
        order_items=[item("I1", "O1", "P1", qty=2), item("I2", "O1", "P2", price="9.99", discount="1.50"),
                     item("I3", "O2", "P1", qty=3, discount="4.00"), item("I4", "O3", "P2")],
        returns=[ret("R1", "I1", refund="10.00"), ret("R2", "I3", date="2024-03-01", restocked=False)],
        marketing_spend=[spend("2024-01-03", "Organic Search", "12.00")])
    return MartBuild(src)


def variant(build, **frames):
    """The build with some marts or staged frames replaced; marts come from storage."""
    b = MartBuild(build.src)
    stored = dict(build.stored())
    for name, change in frames.items():
        if name in stored:
            stored[name] = change(stored[name])
        else:
            b.__dict__[name] = change(getattr(build, name))
    b._stored = stored
    b.__dict__.update(stored, kept=b)
    return b


def put(column, value, where="true"):
    from pyspark.sql import functions as F

    return lambda df: df.withColumn(column, F.when(F.expr(where), F.expr(value).cast(df.schema[column].dataType))
                                    .otherwise(F.col(column)))


def twice(df):
    return df.unionByName(df)


BROKEN = [
    (C.c01_populated, {"fct_returns": lambda d: d.limit(0)}, 1),
    (C.c02_published, {"fct_returns": lambda d: d.limit(0)}, 1),
    (C.c03_key_unique, {"dim_product": twice}, 1),
    (C.c04_key_not_null, {"fct_cohort_repeat": put("period_index", "null")}, 1),
    (C.c05_lines_resolve, {"fct_order_items": put("product_id", "'PX'", "order_item_id = 'I4'")}, 1),
    (C.c06_returns_resolve, {"fct_returns": put("order_item_id", "'IX'", "return_id = 'R1'")}, 1),
    (C.c07_returned_le_ordered, {"fct_order_items": put("quantity_returned", "99", "order_item_id = 'I1'")}, 1),
    (C.c08_return_after_order, {"fct_returns": put("return_date", "date'2023-01-01'", "return_id = 'R2'")}, 1),
    (C.c09_delivery_ordered, {"orders": put("delivered_date", "date'2023-01-01'", "order_id = 'O2'")}, 1),
    (C.c10_pickups_excluded, {"fct_fulfilment_daily": put("fulfilment_centre", "'Store Pickup'")}, 1),
    (C.c10_pickups_excluded, {"orders": put("promised_delivery_date", "date'2024-01-01'", "not is_shipped")}, 1),
    (C.c11_band_boundaries, {"fct_order_items": put("discount_band", "'0%'", "discount_rate > 0")}, 1),
    (C.c12_cohort_proportions, {"fct_cohort_repeat": put("active_rate", "1.5", "period_index = 0")}, 1),
    (C.c13_cohort_size_fixed, {"fct_cohort_repeat": put("cohort_customers", "77", "period_index = 0")}, 1),
    (C.c14_cohort_dense, {"fct_cohort_repeat": put("period_index", "9", "period_index = 1")}, 1),
    (C.c15_margin_identity, {"fct_order_items": put("contribution_margin", "contribution_margin + 1.01", "order_item_id = 'I1'")}, 1),
    (C.c16_realised_identity, {"fct_order_items": put("realised_revenue", "realised_revenue - 1", "order_item_id = 'I1'")}, 1),
    (C.c17_net_identity, {"fct_order_items": put("gross_revenue", "gross_revenue + 1", "order_item_id = 'I1'")}, 1),
    (C.c18_freight_reconciles, {"orders": put("shipping_cost", "shipping_cost + 5", "order_id = 'O1'")}, 1),
    (C.line_identities, {"fct_order_items": put("contribution_margin", "contribution_margin + 0.02", "order_item_id = 'I1'")}, 1),
    (C.line_identities, {"fct_order_items": put("realised_revenue", "realised_revenue + 0.01", "order_item_id = 'I4'")}, 1),
    (C.line_identities, {"orders": put("shipping_cost", "shipping_cost + 0.02", "order_id = 'O1'")}, 1),
    (C.line_identities, {"fct_order_items": lambda d: d.filter("order_id <> 'O1'")}, 1),
    (C.c19_cogs_recovery, {"economics": put("cogs_recovered", "1", "not is_restocked")}, 1),
    (C.c20_payback_identity, {"fct_channel_payback": put("cumulative_margin_net_of_cac", "cumulative_margin_net_of_cac + 0.02")}, 1),
    (C.c21_fulfilment_counts, {"fct_fulfilment_daily": put("late_orders", "late_orders + 1")}, 1),
    (C.c22_net_revenue_agrees, {"dim_product": put("net_revenue", "net_revenue + 1")}, 1),
    (C.c23_margin_agrees, {"fct_discount_bands": put("contribution_margin", "contribution_margin + 1")}, 1),
    (C.c24_customer_orders_agree, {"dim_customer": put("orders", "orders + 1", "customer_id = 'C3'")}, 1),
    (C.c25_cohort_for_orderers, {"dim_customer": put("cohort_month", "null", "customer_id = 'C2'")}, 1),
    (C.c26_dates_in_window, {"fct_order_items": put("order_date", "date'2030-01-01'", "order_item_id = 'I2'")}, 1),
    (C.c28_schema_contract, {"dim_product": lambda d: d.drop("sku")}, 1),
    (C.c28_schema_contract, {"dim_product": lambda d: d.drop("contribution_margin")}, 1),
]


@pytest.mark.parametrize("k", range(len(BROKEN)))
def test_contract_passes_when_sound_and_reports_when_broken(sound, k):
    contract, frames, bad = BROKEN[k]
    assert all(r["ok"] for r in contract(variant(sound)).collect())
    assert sum(not r["ok"] for r in contract(variant(sound, **frames)).collect()) == bad


def test_rebuild_compares_rows(sound):
    assert all(r["ok"] and r["differing_rows"] == 0 and r["rows"] > 0 for r in C.c27_rebuild(sound).collect())
    a = sound.stored()["fct_order_items"]
    changed = put("net_revenue", "net_revenue + 1", "order_item_id = 'I1'")(a)
    assert sorted(r["surplus"] for r in C.differing_rows(a, changed).collect()) == [-1, 1]
    assert C.differing_rows(a, a).collect() == []


def test_staged_orphans_and_duplicates_are_counted(spark):
    src = raw_sources(
        spark, customers=[customer("C1"), customer("C1")], products=[product("P1")],
        orders=[order("O1", "C1"), order("O2", "CX"), order("O2", "C1")],
        order_items=[item("I1", "O1", "P1"), item("I2", "OX", "P1"), item("I3", "O1", "PX"), item("I3", "O1", "P1")],
        returns=[ret("R1", "I1"), ret("R2", "I1"), ret("R3", "IX")])
    got = {r["subject"]: r["violations"] for r in C.staged_orphans(MartBuild(src)).collect()}
    assert got == {
        "order_items.order_id": 1, "order_items.product_id": 1, "orders.customer_id": 1, "returns.order_item_id": 1,
        "returns.order_item_id.repeated": 1, "order_items.order_item_id.repeated": 1, "orders.order_id.repeated": 1,
        "customers.customer_id.repeated": 1, "products.product_id.repeated": 0}


def test_tolerances_do_not_grow_with_the_lines(spark):
    """Three thousand lines off by a tenth of a penny's worth each: the total says so."""
    src = raw_sources(spark, customers=[customer("C1")], products=[product("P1")],
                      orders=[order("O1", "C1", cost="0.00")],
                      order_items=[item(f"I{i}", "O1", "P1") for i in range(3000)])
    b = MartBuild(src)
    off = variant(b, fct_order_items=put("realised_revenue", "realised_revenue + 0.01", "order_item_id < 'I20'"))
    r = C.c16_realised_identity(off).first()
    assert r["tolerance"] == 1.0 and r["gap"] > 1 and not r["ok"]


def test_return_products_keep_every_product_and_can_be_cut(sound):
    from ledgerwalk.plans.analyses import answer_return_products

    rows = answer_return_products(sound).collect()
    assert {(r["return_reason"], r["product_id"]) for r in rows} == {("Changed mind", "P1")}
    assert rows[0]["share_of_reason"] == 1.0
    assert answer_return_products(sound, top=1).count() == 1
