"""Co-located storage: the marts of a bucketed build, their joins and their plans."""

import glob
import os
import random
import tempfile

import pytest
from builders import customer, item, order, product, raw_sources, ret, spend
from ledgerwalk.plans.checks import differing_rows
from ledgerwalk.plans.marts import MartBuild
from ledgerwalk.sources.colocated import exchanges_below_joins, forget_tables, store_bucketed
from ledgerwalk.sources.contracts import PUBLISHED


def shop(spark, customers=40, orders=300, seed=3):
    """A shop with returns, pick-ups, customers without orders and one with a third of all orders."""
    rnd = random.Random(seed)
    cs = [customer(f"C{i}", signup=f"2024-0{1 + i % 6}-05", channel=["Email", "Search", "Social"][i % 3]) for i in range(customers)]
    ps = [product(f"P{i}", cost=f"{3 + i}.00", category=["Home", "Toys"][i % 2]) for i in range(7)]
    os_, items, rets = [], [], []
    for o in range(orders):
        c = 0 if o % 3 == 0 else 1 + rnd.randrange(customers - 5)
        month = 1 + o % 9
        os_.append(order(f"O{o}", f"C{c}", date=f"2024-0{month}-{1 + o % 27:02d}", shipped=o % 7 != 0, promised=f"2024-0{month}-28",
                         ship_date=f"2024-0{month}-28", delivered=f"2024-0{month}-{27 + o % 2:02d}", fee="4.99", cost="6.10"))
        for k in range(rnd.randint(1, 4)):
            i = f"I{o}-{k}"
            items.append(item(i, f"O{o}", f"P{rnd.randrange(7)}", qty=rnd.randint(1, 3), price=f"{rnd.randint(5, 60)}.50",
                              discount=rnd.choice(["0.00", "1.00", "2.25"])))
            if rnd.random() < 0.2:
                rets.append(ret(f"R{i}", i, date=f"2024-1{o % 3}-01", refund="5.00", restocked=bool(o % 2), reason=f"Reason {k}"))
    sp = [spend(f"2024-0{1 + m}-01", ch, f"{50 + m}.00") for m in range(6) for ch in ("Email", "Search")]
    return raw_sources(spark, customers=cs, products=ps, orders=os_, order_items=items, returns=rets, marketing_spend=sp)


@pytest.fixture(scope="module")
def builds(spark):
    src = shop(spark)
    folder = tempfile.mkdtemp(prefix="lw-colocated-")
    return MartBuild(src), MartBuild(src, folder=folder, buckets=5), folder


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_marts_are_unchanged(builds):
    plain, bucketed, _ = builds
    for m in PUBLISHED:
        assert differing_rows(getattr(plain, m), getattr(bucketed, m)).isEmpty(), m


@pytest.mark.parametrize("mart, key", [("dim_customer", "customer_id"), ("fct_fulfilment_daily", "order_id"),
                                       ("fct_cohort_repeat", "customer_id"), ("fct_channel_payback", "customer_id")])
def test_no_shuffle_below_the_joins_on_the_key(builds, no_broadcast, mart, key):
    plain, bucketed, _ = builds
    getattr(bucketed, mart)  # its tables are stored
    found = exchanges_below_joins(getattr(bucketed, mart), key)
    assert found and not any(found)
    assert any(exchanges_below_joins(getattr(plain, mart), key))


def test_profile_joins_header_and_rollup_without_a_shuffle(builds, no_broadcast):
    _, bucketed, _ = builds
    r = bucketed.order_rollup.select("order_id", "net_revenue")
    assert exchanges_below_joins(bucketed.orders.join(r, "order_id", "left"), "order_id") == [0]


def test_one_sorted_file_a_bucket_and_tables_can_be_forgotten(spark):
    folder = tempfile.mkdtemp(prefix="lw-colocated-")
    df = spark.range(1000).selectExpr("id % 37 AS k", "id AS v").repartition(6)
    stored = store_bucketed(df, folder, "t", "k", 4)
    files = glob.glob(os.path.join(folder, "t", "part-*"))
    assert len(files) == 4 and sorted(map(tuple, stored.collect())) == sorted(map(tuple, df.collect()))
    for f in files:
        keys = [r["k"] for r in spark.read.parquet(f).collect()]
        assert keys == sorted(keys)
    name = [t.name for t in spark.catalog.listTables() if t.name.startswith("colocated_t_")]
    assert len(name) == 1
    forget_tables(spark, folder)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("colocated_t_")]
    assert len(glob.glob(os.path.join(folder, "t", "part-*"))) == 4
