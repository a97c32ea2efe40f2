"""Data contracts C1-C28 as Spark jobs.

Count contracts return rows ``(contract, subject, violations, ok)``; money
reconciliations return ``(contract, subject, lhs, rhs, gap, tolerance, ok)``.
An empty violation set / a gap inside tolerance is a pass. Totals are held to the
published absolute tolerances whatever the number of lines; beside them stand counts of
the single lines and orders that break an identity, which don't depend on size.
Contracts over many marts read one stored build.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ledgerwalk.functions.banding import band_labels
from ledgerwalk.functions.numeric import MONEY_SUM
from ledgerwalk.plans.marts import MartBuild
from ledgerwalk.sources.contracts import MART_COLUMNS, PRIMARY_KEYS, PUBLISHED

# Published tolerances of totals.
PENCE = 1.00
ALLOCATION = 5.00
#: Marts with a row for each line or return.
OF_LINES = ("fct_order_items", "fct_returns")
#: A line's margin is rounded once and its freight once, each to the penny.
LINE_PENNY = Decimal("0.01")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _count(df: DataFrame, cid: str, subject: str, cond: Column) -> DataFrame:
    """One row: how many rows of ``df`` violate (``cond`` true)."""
    return df.agg(F.count_if(cond).alias("violations")).select(
        F.lit(cid).alias("contract"), F.lit(subject).alias("subject"), "violations",
        (F.col("violations") == 0).alias("ok"))


def _n(df: DataFrame, cid: str, subject: str) -> DataFrame:
    """One row from a frame whose rows are the violations."""
    return _count(df, cid, subject, F.lit(True))


def _recon(cid: str, subject: str, totals: DataFrame, tolerance: float) -> DataFrame:
    """``totals``: a one-row frame with ``lhs`` and ``rhs``."""
    gap = (F.col("lhs") - F.col("rhs")).cast(MONEY_SUM)
    return totals.select(F.col("lhs").cast(MONEY_SUM), F.col("rhs").cast(MONEY_SUM)).select(
        F.lit(cid).alias("contract"), F.lit(subject).alias("subject"), "lhs", "rhs",
        gap.alias("gap"), F.lit(tolerance).alias("tolerance"),
        (F.abs(gap.cast("double")) < F.lit(tolerance)).alias("ok"))


def _sums(df: DataFrame, lhs: Column, rhs: Column) -> DataFrame:
    """Both sides in one pass over ``df``."""
    return df.agg(F.sum(lhs).alias("lhs"), F.sum(rhs).alias("rhs"))


def _two(left: DataFrame, lhs: Column, right: DataFrame, rhs: Column) -> DataFrame:
    """The sides from two frames, each a one-row aggregate."""
    return left.agg(F.sum(lhs).alias("lhs")).crossJoin(right.agg(F.sum(rhs).alias("rhs")))


# ------------------------------------------------------------------- shape
def c01_populated(b: MartBuild) -> DataFrame:
    marts = b.stored()
    return _union([
        marts[m].agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit("C01").alias("contract"), F.lit(m).alias("subject"), "rows",
            (F.col("rows") > 0).alias("ok"))
        for m in PUBLISHED])


def c02_published(b: MartBuild, folder: str | None = None, fmt: str = "csv") -> DataFrame:
    """Publish every mart, read each back through the manifest and count its rows."""
    from ledgerwalk.session import run_folder
    from ledgerwalk.sources.publish import publish, published

    folder = folder or run_folder(b.spark, "published")
    publish(b.stored(), folder, fmt=fmt, compression="gzip" if fmt == "csv" else None)
    back = published(b.spark, folder)
    return _union([back[m].agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("C02").alias("contract"), F.lit(m).alias("subject"), "rows",
        (F.col("rows") > 0).alias("ok")) for m in PUBLISHED])


def published_order(b: MartBuild, folder: str | None = None, fmt: str = "csv") -> DataFrame:
    """S6 + S7: publish every mart, and hold the published files against the total order and the
    row counts that the publish gave."""
    from ledgerwalk.session import run_folder
    from ledgerwalk.sources.publish import files_in_order, publish, published

    folder = folder or run_folder(b.spark, "published")
    written = publish(b.stored(), folder, fmt=fmt, compression="gzip" if fmt == "csv" else None)
    back = published(b.spark, folder)
    return _union([files_in_order(back[m]).select(
        F.lit(m).alias("mart"), F.lit(written[m]).cast("long").alias("written_rows"), "rows", "out_of_order",
        ((F.col("rows") == written[m]) & (F.col("out_of_order") == 0)).alias("ok")) for m in PUBLISHED])


def c03_key_unique(b: MartBuild) -> DataFrame:
    frames = []
    for m in sorted(PRIMARY_KEYS):
        dup = b.stored()[m].groupBy(*PRIMARY_KEYS[m]).count().filter(F.col("count") > 1)
        frames.append(_n(dup, "C03", m))
    return _union(frames)


def c04_key_not_null(b: MartBuild) -> DataFrame:
    frames = []
    for m in sorted(PRIMARY_KEYS):
        keys = PRIMARY_KEYS[m]
        agg = b.stored()[m].agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys])
        stack = ", ".join(f"'{m}.{k}', `{k}`" for k in keys)
        frames.append(agg.selectExpr(f"stack({len(keys)}, {stack}) AS (subject, violations)"))
    return _union(frames).select(F.lit("C04").alias("contract"), "subject", "violations",
                                 (F.col("violations") == 0).alias("ok"))


# --------------------------------------------------------------- integrity
def c05_lines_resolve(b: MartBuild) -> DataFrame:
    # both dimensions have a row for every staged id, so the ids come from staging
    f = b.fct_order_items.select("customer_id", "product_id")
    no_c = f.join(b.stg.customers.select("customer_id"), "customer_id", "left_anti")
    no_p = f.join(b.stg.products.select("product_id"), "product_id", "left_anti")
    return _union([_n(no_c, "C05", "fct_order_items.customer_id"),
                   _n(no_p, "C05", "fct_order_items.product_id")])


def c06_returns_resolve(b: MartBuild) -> DataFrame:
    orphan = b.fct_returns.select("order_item_id").join(
        b.fct_order_items.select("order_item_id"), "order_item_id", "left_anti")
    return _n(orphan, "C06", "fct_returns.order_item_id")


def c07_returned_le_ordered(b: MartBuild) -> DataFrame:
    return _count(b.fct_order_items, "C07", "fct_order_items",
                  F.col("quantity_returned") > F.col("quantity"))


def c08_return_after_order(b: MartBuild) -> DataFrame:
    return _count(b.fct_returns, "C08", "fct_returns", F.col("return_date") < F.col("order_date"))


def c09_delivery_ordered(b: MartBuild) -> DataFrame:
    return _count(b.orders, "C09", "stg_orders",
                  F.col("is_shipped") & (F.col("delivered_date") < F.col("shipped_date")))


def c10_pickups_excluded(b: MartBuild) -> DataFrame:
    return _union([
        _count(b.fct_fulfilment_daily, "C10", "fct_fulfilment_daily.store_pickup",
               F.col("fulfilment_centre") == "Store Pickup"),
        _count(b.orders, "C10", "stg_orders.pickup_promise",
               ~F.col("is_shipped") & F.col("promised_delivery_date").isNotNull()),
    ])


def band_violation(rate: Column, band: Column, edges) -> Column:
    labels = band_labels(edges)
    ds = [F.lit(Decimal(repr(e))) for e in edges]
    cond = (rate == 0) & (band != labels[0])
    cond = cond | ((rate > 0) & (rate < ds[0]) & (band != labels[1]))
    for i in range(len(ds) - 1):
        cond = cond | ((rate >= ds[i]) & (rate < ds[i + 1]) & (band != labels[i + 2]))
    return cond | ((rate >= ds[-1]) & (band != labels[-1]))


def c11_band_boundaries(b: MartBuild) -> DataFrame:
    return _count(b.fct_order_items, "C11", "fct_order_items",
                  band_violation(F.col("discount_rate"), F.col("discount_band"), b.band_edges))


def c12_cohort_proportions(b: MartBuild) -> DataFrame:
    c = b.fct_cohort_repeat
    return _count(c, "C12", "fct_cohort_repeat",
                  (F.col("active_rate") < 0) | (F.col("active_rate") > 1)
                  | (F.col("active_customers") > F.col("cohort_customers")))


def c13_cohort_size_fixed(b: MartBuild) -> DataFrame:
    moving = (b.fct_cohort_repeat.groupBy("cohort_month", "first_order_experience")
              .agg(F.countDistinct("cohort_customers").alias("sizes"))
              .filter(F.col("sizes") > 1))
    return _n(moving, "C13", "fct_cohort_repeat")


def c14_cohort_dense(b: MartBuild) -> DataFrame:
    gaps = (b.fct_cohort_repeat.groupBy("cohort_month", "first_order_experience")
            .agg((F.max("period_index") - F.min("period_index") + 1).alias("expected"),
                 F.count(F.lit(1)).alias("actual"))
            .filter(F.col("expected") != F.col("actual")))
    return _n(gaps, "C14", "fct_cohort_repeat")


# ---------------------------------------------------------------- identity
#: C15-C17 as (contract, subject, left side, right side) of a line.
IDENTITIES = (
    ("C15", "contribution_margin", "contribution_margin",
     "realised_revenue - cogs - net_shipping_cost"),
    ("C16", "realised_revenue", "realised_revenue", "net_revenue - refund_amount"),
    ("C17", "net_revenue", "net_revenue", "gross_revenue - discount_amount"),
)


def _identity(b: MartBuild, k: int) -> DataFrame:
    cid, subject, lhs, rhs = IDENTITIES[k]
    return _recon(cid, subject, _sums(b.fct_order_items, F.expr(lhs), F.expr(rhs)), PENCE)


def c15_margin_identity(b: MartBuild) -> DataFrame:
    return _identity(b, 0)


def c16_realised_identity(b: MartBuild) -> DataFrame:
    return _identity(b, 1)


def c17_net_identity(b: MartBuild) -> DataFrame:
    return _identity(b, 2)


def c18_freight_reconciles(b: MartBuild) -> DataFrame:
    return _recon("C18", "net_shipping_cost", _two(
        b.fct_order_items, F.col("net_shipping_cost"),
        b.orders, F.col("shipping_cost") - F.col("shipping_fee_charged")), ALLOCATION)


def line_identities(b: MartBuild) -> DataFrame:
    """C15-C18 line by line and order by order: counts that don't depend on size.

    C16 and C17 are exact in decimals; a line's margin may differ by its two roundings, a
    penny in all. An order's lines may miss its header freight by half a penny each, and
    orders without lines, whose freight nobody carries, are a subject of their own.
    """
    f = b.fct_order_items
    lines = f.agg(
        F.count_if(F.abs(F.expr(IDENTITIES[0][2]) - F.expr(IDENTITIES[0][3])) > F.lit(LINE_PENNY)).alias("c15"),
        *[F.count_if(F.expr(lhs) != F.expr(rhs)).alias(cid.lower()) for cid, _, lhs, rhs in IDENTITIES[1:]])
    per = f.groupBy("order_id").agg(F.sum("net_shipping_cost").alias("allocated"),
                                    F.count(F.lit(1)).alias("lines"))
    o = b.orders.select("order_id", (F.col("shipping_cost") - F.col("shipping_fee_charged")).alias("freight"))
    o = o.join(per, "order_id", "left")
    off = F.abs(F.col("allocated") - F.col("freight")) * 200 > F.col("lines")
    orders = o.agg(F.count_if(off).alias("c18"),
                   F.count_if(F.col("lines").isNull() & (F.col("freight") != 0)).alias("c18_none"))
    rows = lines.crossJoin(orders).selectExpr(
        "stack(5, 'C15', 'contribution_margin.lines', c15, 'C16', 'realised_revenue.lines', c16, "
        "'C17', 'net_revenue.lines', c17, 'C18', 'net_shipping_cost.orders', c18, "
        "'C18', 'net_shipping_cost.orders_without_lines', c18_none) AS (contract, subject, violations)")
    return rows.withColumn("ok", F.col("violations") == 0)


def staged_orphans(b: MartBuild) -> DataFrame:
    """What inner joins would drop, and duplicates that would fan out, on staged inputs."""
    s = b.stg

    def orphans(df: DataFrame, key: str, known: DataFrame, subject: str) -> DataFrame:
        return _n(df.select(key).join(known.select(key), key, "left_anti"), "T10", subject)

    def repeated(df: DataFrame, key: str, subject: str) -> DataFrame:
        return _n(df.groupBy(key).count().filter(F.col("count") > 1), "T10", subject)

    return _union([
        orphans(s.order_items, "order_id", b.orders, "order_items.order_id"),
        orphans(s.order_items, "product_id", s.products, "order_items.product_id"),
        orphans(b.orders, "customer_id", s.customers, "orders.customer_id"),
        orphans(s.returns, "order_item_id", s.order_items, "returns.order_item_id"),
        repeated(s.returns, "order_item_id", "returns.order_item_id.repeated"),
        repeated(s.order_items, "order_item_id", "order_items.order_item_id.repeated"),
        repeated(b.orders, "order_id", "orders.order_id.repeated"),
        repeated(s.customers, "customer_id", "customers.customer_id.repeated"),
        repeated(s.products, "product_id", "products.product_id.repeated"),
    ])


def c19_cogs_recovery(b: MartBuild) -> DataFrame:
    return _count(b.economics, "C19", "order_item_economics",
                  ~F.col("is_restocked") & (F.col("cogs_recovered") != 0))


def c20_payback_identity(b: MartBuild) -> DataFrame:
    p = b.fct_channel_payback
    return _count(p, "C20", "fct_channel_payback",
                  F.abs(F.col("cumulative_margin_net_of_cac")
                        - (F.col("cumulative_contribution_margin") - F.col("acquisition_spend")))
                  > F.lit(Decimal("0.01")))


def c21_fulfilment_counts(b: MartBuild) -> DataFrame:
    f = b.fct_fulfilment_daily
    return _count(f, "C21", "fct_fulfilment_daily",
                  F.col("on_time_orders") + F.col("late_orders") != F.col("orders"))


# --------------------------------------------------------------- agreement
def c22_net_revenue_agrees(b: MartBuild) -> DataFrame:
    k = b.light
    return _union([
        _recon("C22", f"{m}.{c}", _two(k.fct_order_items, F.col("net_revenue"),
                                       getattr(k, m), F.col(c)), PENCE)
        for m, c in [("dim_product", "net_revenue"), ("dim_customer", "lifetime_net_revenue"),
                     ("fct_discount_bands", "net_revenue")]])


def c23_margin_agrees(b: MartBuild) -> DataFrame:
    k, cm = b.light, F.col("contribution_margin")
    return _union([
        _recon("C23", f"{m}.contribution_margin", _two(k.fct_order_items, cm, getattr(k, m), cm), PENCE)
        for m in ["dim_product", "fct_discount_bands"]])


def c24_customer_orders_agree(b: MartBuild) -> DataFrame:
    """(customer, order) pairs of the published lines, each once, against the profile's count; both
    plans prune the line fact to those columns, so nothing is stored for them."""
    k = b.light
    pairs = k.fct_order_items.select("customer_id", "order_id").distinct()
    per = pairs.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    c = k.dim_customer.select("customer_id", "orders").join(per, "customer_id", "left")
    return _count(c, "C24", "dim_customer.orders",
                  F.col("orders") != F.coalesce(F.col("n"), F.lit(0)))


def c25_cohort_for_orderers(b: MartBuild) -> DataFrame:
    return _count(b.dim_customer, "C25", "dim_customer",
                  (F.col("orders") > 0) & F.col("cohort_month").isNull())


def c26_dates_in_window(b: MartBuild) -> DataFrame:
    bounds = b.orders.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    f = b.fct_order_items.select("order_date").crossJoin(F.broadcast(bounds))
    return _count(f, "C26", "fct_order_items.order_date",
                  (F.col("order_date") < F.col("lo")) | (F.col("order_date") > F.col("hi")))


# ------------------------------------------------------- reproducibility etc.
def fingerprint(df: DataFrame) -> DataFrame:
    """C27 helper: order-insensitive content fingerprint (rows, sum of row hashes)."""
    h = F.xxhash64(*[F.col(c) for c in df.columns]).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(h).alias("fingerprint"))


def c27_fingerprints(b: MartBuild) -> DataFrame:
    marts = b.stored()
    return _union([fingerprint(marts[m]).select(
        F.lit("C27").alias("contract"), F.lit(m).alias("subject"), "rows",
        F.col("fingerprint").cast("string").alias("fingerprint")) for m in PUBLISHED])


def differing_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other, with ``surplus`` of the left side:
    exceptAll both ways in one aggregate."""
    cols = a.columns
    both = a.withColumn("_side", F.lit(1)).unionByName(b.select(*cols).withColumn("_side", F.lit(-1)))
    return both.groupBy(*cols).agg(F.sum("_side").alias("surplus")).filter(F.col("surplus") != 0)


def differing_count(a: DataFrame, b: DataFrame, mart: str, slices: int = 1) -> DataFrame:
    """``differing_rows`` of two copies of a mart, all of them: one row, one column of that name. A mart of
    lines is compared in ``slices`` of its key, so that the shuffle of one stands at a time."""
    from ledgerwalk.session import run_folder
    from ledgerwalk.sources.publish import materialise_frame

    def count(x: DataFrame, y: DataFrame) -> DataFrame:
        return differing_rows(x, y).agg(F.coalesce(F.sum(F.abs("surplus")), F.lit(0)).alias("differing_rows"))

    key = PRIMARY_KEYS[mart]
    same = all(a.schema[k].dataType == b.schema[k].dataType for k in key)  # else equal keys may have other hashes
    if slices == 1 or not same or mart not in OF_LINES:
        return count(a, b)
    folder, h = run_folder(a.sparkSession, "differing"), F.pmod(F.xxhash64(*key), F.lit(slices))
    found = _union([materialise_frame(count(a.where(h == k), b.where(h == k)), folder, f"{mart}-{k}") for k in range(slices)])
    return found.agg(F.sum("differing_rows").alias("differing_rows"))


def differing_in_buckets(store, table: str, old: int, new: int) -> tuple[DataFrame, int]:
    """``differing_rows`` of two versions of a table that is stored by key-hash buckets, and the number
    of buckets read for it: only those whose sums differ."""
    from ledgerwalk.sources.versions import differing_parts

    parts = differing_parts(store, table, old, new)
    return differing_rows(store.read(table, parts, old), store.read(table, parts, new)), len(parts)


def c27_buckets(b: MartBuild, buckets: int = 64) -> DataFrame:
    """C27 by bucket: the line fact is stored twice, the second time with one unit more on one line; the
    line is found by comparing bucket sums and reading the one bucket that differs."""
    from ledgerwalk.session import drop_folder, run_folder
    from ledgerwalk.sources.publish import materialise_frame
    from ledgerwalk.sources.versions import VersionedStore, part_of

    lines = run_folder(b.spark, "lines")
    # of the marts this reads the line fact alone; a build that has stored them already gives its copy
    if b.has_stored:
        fact = b.stored()["fct_order_items"]
    else:
        fact = (materialise_frame(b.fct_order_items, lines, "fct_order_items") if b.slices == 1
                else b.in_slices(b.published_lines, lines))
    store = VersionedStore(b.spark, run_folder(b.spark, "versions"))

    def put(df: DataFrame, **how) -> int:
        return store.commit(store.stage_parts(df, "fct_order_items", "_part", **how))

    old = put(fact.withColumn("_part", part_of("order_item_id", parts=buckets)), slices=b.slices)
    if not b.has_stored:
        drop_folder(b.spark, lines)
    # the second version is made from the first one's files, bucket by bucket, so that no line moves
    fact = store.read_with_parts("fct_order_items", "_part", old)
    last = fact.agg(F.max("order_item_id").alias("_last"))
    more = F.when(F.col("order_item_id") == F.col("_last"), F.col("quantity") + 1).otherwise(F.col("quantity"))
    new = put(fact.crossJoin(F.broadcast(last)).withColumn("quantity", more.cast("int")).drop("_last"), dealt=True)
    rows, read = differing_in_buckets(store, "fct_order_items", old, new)
    return rows.select(F.lit("C27").alias("contract"), "order_item_id", "quantity", "surplus",
                       F.lit(read).cast("long").alias("buckets_read"))


def c27_rebuild(b: MartBuild, partitions: int = 7) -> DataFrame:
    """Build all marts twice, the second time with another number of shuffle partitions and
    without adaptive coalescing, and compare the stored results row by row."""
    spark = b.spark
    first = b.stored()
    keys = {"spark.sql.shuffle.partitions": str(partitions),
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        second = MartBuild(b.src, b.band_edges).stored()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return _union([
        first[m].agg(F.count(F.lit(1)).alias("rows")).crossJoin(
            differing_count(first[m], second[m], m, b.slices)).select(
            F.lit("C27").alias("contract"), F.lit(m).alias("subject"), "rows", "differing_rows",
            (F.col("differing_rows") == 0).alias("ok"))
        for m in PUBLISHED])


def c28_schema_contract(b: MartBuild, folder: str | None = None) -> DataFrame:
    """Publish every mart as CSV, read the files back and hold their columns and ordinals
    against the contract; the mart's metrics are evaluated on what was read, and those
    that don't resolve on its columns are counted too."""
    from pyspark.errors import AnalysisException

    from ledgerwalk.plans.metrics import METRICS
    from ledgerwalk.session import run_folder
    from ledgerwalk.sources.publish import publish
    from ledgerwalk.sources.versions import CSV_OPTIONS, VersionedStore

    spark = b.spark
    folder = folder or run_folder(spark, "published")
    marts = b.stored()
    publish(marts, folder, compression="gzip")
    frames = []
    for entry in VersionedStore(spark, folder).entries():
        m = entry.table
        back = spark.read.options(**CSV_OPTIONS).csv(f"{folder}/{entry.path}")  # names as the files have them
        want = list(enumerate(MART_COLUMNS[m]))
        found = spark.createDataFrame(list(enumerate(back.columns)), "ordinal int, found string")
        want = spark.createDataFrame(want, "ordinal int, wanted string")
        match = found.join(want, "ordinal", "full").agg(
            F.count("found").alias("columns"),
            F.count_if(~F.col("found").eqNullSafe(F.col("wanted"))).alias("mismatches"))
        typed = back.select(*[F.col(f.name).cast(f.dataType) for f in marts[m].schema
                              if f.name in back.columns])
        unresolved = 0
        for metric in [x for x in METRICS.values() if x.dataset == m]:
            try:
                typed.agg(metric.build({}))
            except AnalysisException:
                unresolved += 1
        rows = back.agg(F.count(F.lit(1)).alias("rows"))
        frames.append(match.crossJoin(rows).select(
            F.lit("C28").alias("contract"), F.lit(m).alias("subject"), "columns", "mismatches",
            F.lit(unresolved).cast("long").alias("unresolved_metrics"), "rows",
            ((F.col("mismatches") == 0) & F.lit(unresolved == 0)).alias("ok")))
    return _union(frames)


CONTRACTS = {
    "contract_c01": c01_populated, "contract_c02": c02_published,
    "contract_c03": c03_key_unique, "contract_c04": c04_key_not_null,
    "contract_c05": c05_lines_resolve, "contract_c06": c06_returns_resolve,
    "contract_c07": c07_returned_le_ordered, "contract_c08": c08_return_after_order,
    "contract_c09": c09_delivery_ordered, "contract_c10": c10_pickups_excluded,
    "contract_c11": c11_band_boundaries, "contract_c12": c12_cohort_proportions,
    "contract_c13": c13_cohort_size_fixed, "contract_c14": c14_cohort_dense,
    "contract_c15": c15_margin_identity, "contract_c16": c16_realised_identity,
    "contract_c17": c17_net_identity, "contract_c18": c18_freight_reconciles,
    "contract_c19": c19_cogs_recovery, "contract_c20": c20_payback_identity,
    "contract_c21": c21_fulfilment_counts, "contract_c22": c22_net_revenue_agrees,
    "contract_c23": c23_margin_agrees, "contract_c24": c24_customer_orders_agree,
    "contract_c25": c25_cohort_for_orderers, "contract_c26": c26_dates_in_window,
    "contract_c27": c27_rebuild, "contract_line_identities": line_identities,
    "contract_staged_orphans": staged_orphans,
}


def line_checks(b: MartBuild) -> DataFrame:
    """C7, C11 and C19 in one scan of the wide line fact (count shape)."""
    f = b.fact
    published = F.col("_customer_known")
    band = band_columns_for(b)
    agg = f.agg(
        F.count_if(published & (F.col("quantity_returned") > F.col("quantity"))).alias("C07"),
        F.count_if(published & band_violation(F.col("discount_rate"), band,
                                              b.band_edges)).alias("C11"),
        F.count_if(~F.col("is_restocked") & (F.col("cogs_recovered") != 0)).alias("C19"),
    )
    rows = agg.selectExpr("stack(3, 'C07', 'fct_order_items', C07, 'C11', 'fct_order_items', "
                          "C11, 'C19', 'order_item_economics', C19) AS (contract, subject, violations)")
    return rows.withColumn("ok", F.col("violations") == 0)


def band_columns_for(b: MartBuild) -> Column:
    from ledgerwalk.functions.banding import band_columns

    return band_columns("discount_rate", b.band_edges)[0]


def identity_checks(b: MartBuild) -> DataFrame:
    """C15-C17 in one scan of the published line fact (reconciliation shape)."""
    s = b.fct_order_items.agg(*[F.sum(F.expr(e)).cast(MONEY_SUM).alias(f"{cid}_{side}")
                                for cid, _, lhs, rhs in IDENTITIES
                                for side, e in (("lhs", lhs), ("rhs", rhs))])
    stack = ", ".join(f"'{cid}', '{subject}', {cid}_lhs, {cid}_rhs" for cid, subject, _, _ in IDENTITIES)
    rows = s.selectExpr(f"stack({len(IDENTITIES)}, {stack}) AS (contract, subject, lhs, rhs)")
    gap = (F.col("lhs") - F.col("rhs")).cast(MONEY_SUM)
    return rows.select(
        "contract", "subject", F.col("lhs").cast(MONEY_SUM).alias("lhs"),
        F.col("rhs").cast(MONEY_SUM).alias("rhs"), gap.alias("gap"),
        F.lit(PENCE).alias("tolerance"), (F.abs(gap.cast("double")) < F.lit(PENCE)).alias("ok"))


def run_contracts(b: MartBuild) -> DataFrame:
    """All count contracts as one report; line-level ones share a single fact scan."""
    count_ids = ["03", "04", "05", "06", "08", "09", "10", "12", "13", "14",
                 "20", "21", "24", "25", "26"]
    return _union([line_checks(b), line_identities(b), staged_orphans(b)]
                  + [CONTRACTS[f"contract_c{i}"](b) for i in count_ids])


def run_reconciliations(b: MartBuild) -> DataFrame:
    """All money reconciliations (C15-C18, C22, C23) as one report."""
    return _union([identity_checks(b), c18_freight_reconciles(b), c22_net_revenue_agrees(b),
                   c23_margin_agrees(b)])
