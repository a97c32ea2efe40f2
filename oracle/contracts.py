"""Oracle SQL for the data contracts."""

from __future__ import annotations

from oracle.fixed import BAND_EDGES, BAND_LABELS, COLUMNS, KEYS as PRIMARY_KEYS, MARTS as PUBLISHED, SOURCES
from oracle.models import compose

SQL: dict[str, str] = {}


def cnt(cid: str, subject: str, frm: str, where: str) -> str:
    return (f"SELECT '{cid}' AS contract, '{subject}' AS subject, "
            f"count(*) FILTER (WHERE {where}) AS violations, "
            f"count(*) FILTER (WHERE {where}) = 0 AS ok FROM {frm}")


def nrows(cid: str, subject: str, sub: str) -> str:
    return (f"SELECT '{cid}' AS contract, '{subject}' AS subject, count(*) AS violations, "
            f"count(*) = 0 AS ok FROM ({sub})")


def recon(cid: str, subject: str, lhs: str, rhs: str, tolerance: float) -> str:
    return (f"SELECT '{cid}' AS contract, '{subject}' AS subject, lhs, rhs, "
            f"CAST(lhs - rhs AS DECIMAL(38,2)) AS gap, CAST({tolerance} AS DOUBLE) AS tolerance, "
            f"abs(CAST(lhs - rhs AS DOUBLE)) < {tolerance} AS ok FROM "
            f"(SELECT CAST(({lhs}) AS DECIMAL(38,2)) AS lhs, CAST(({rhs}) AS DECIMAL(38,2)) AS rhs)")


U = "\nUNION ALL\n"

SQL["contract_c01"] = compose(U.join(
    f"SELECT 'C01' AS contract, '{m}' AS subject, count(*) AS rows, count(*) > 0 AS ok FROM {m}"
    for m in PUBLISHED), list(PUBLISHED))
SQL["contract_c02"] = SQL["contract_c01"].replace("'C01'", "'C02'")

SQL["published_order"] = compose(U.join(
    f"SELECT '{m}' AS mart, count(*) AS written_rows, count(*) AS rows, CAST(0 AS BIGINT) AS out_of_order, "
    f"true AS ok FROM {m}" for m in PUBLISHED), list(PUBLISHED))

SQL["source_report"] = compose(U.join(
    f"SELECT '{s}' AS source, true AS present, CAST({n} AS BIGINT) AS columns, count(*) AS rows FROM raw_{s}"
    for s, n in SOURCES.items()), [f"raw_{s}" for s in SOURCES])

SQL["contract_c03"] = compose(U.join(
    nrows("C03", m, f"SELECT {', '.join(k)} FROM {m} GROUP BY {', '.join(k)} HAVING count(*) > 1")
    for m, k in sorted(PRIMARY_KEYS.items())), list(PUBLISHED))

SQL["contract_c04"] = compose(U.join(
    f"SELECT 'C04' AS contract, '{m}.{k}' AS subject, count(*) FILTER (WHERE {k} IS NULL) AS violations, "
    f"count(*) FILTER (WHERE {k} IS NULL) = 0 AS ok FROM {m}"
    for m, ks in sorted(PRIMARY_KEYS.items()) for k in ks), list(PUBLISHED))

SQL["contract_c05"] = compose(
    nrows("C05", "fct_order_items.customer_id",
          "SELECT 1 FROM fct_order_items f LEFT JOIN dim_customer c ON c.customer_id = f.customer_id "
          "WHERE c.customer_id IS NULL") + U +
    nrows("C05", "fct_order_items.product_id",
          "SELECT 1 FROM fct_order_items f LEFT JOIN dim_product p ON p.product_id = f.product_id "
          "WHERE p.product_id IS NULL"),
    ["fct_order_items", "dim_customer", "dim_product"])

SQL["contract_c06"] = compose(nrows(
    "C06", "fct_returns.order_item_id",
    "SELECT 1 FROM fct_returns r LEFT JOIN fct_order_items f ON f.order_item_id = r.order_item_id "
    "WHERE f.order_item_id IS NULL"), ["fct_returns", "fct_order_items"])

SQL["contract_c07"] = compose(cnt("C07", "fct_order_items", "fct_order_items",
                                  "quantity_returned > quantity"), ["fct_order_items"])
SQL["contract_c08"] = compose(cnt("C08", "fct_returns", "fct_returns",
                                  "return_date < order_date"), ["fct_returns"])
SQL["contract_c09"] = compose(cnt("C09", "stg_orders", "stg_orders",
                                  "is_shipped AND delivered_date < shipped_date"), ["stg_orders"])
SQL["contract_c10"] = compose(
    cnt("C10", "fct_fulfilment_daily.store_pickup", "fct_fulfilment_daily",
        "fulfilment_centre = 'Store Pickup'") + U +
    cnt("C10", "stg_orders.pickup_promise", "stg_orders",
        "NOT is_shipped AND promised_delivery_date IS NOT NULL"),
    ["fct_fulfilment_daily", "stg_orders"])


def _band_violation(edges=BAND_EDGES) -> str:
    L = BAND_LABELS
    parts = [f"(discount_rate = 0 AND discount_band <> '{L[0]}')",
             f"(discount_rate > 0 AND discount_rate < {edges[0]} AND discount_band <> '{L[1]}')"]
    for i in range(len(edges) - 1):
        parts.append(f"(discount_rate >= {edges[i]} AND discount_rate < {edges[i + 1]} "
                     f"AND discount_band <> '{L[i + 2]}')")
    parts.append(f"(discount_rate >= {edges[-1]} AND discount_band <> '{L[-1]}')")
    return " OR ".join(parts)


SQL["contract_c11"] = compose(cnt("C11", "fct_order_items", "fct_order_items",
                                  _band_violation()), ["fct_order_items"])
SQL["contract_c12"] = compose(cnt(
    "C12", "fct_cohort_repeat", "fct_cohort_repeat",
    "active_rate < 0 OR active_rate > 1 OR active_customers > cohort_customers"),
    ["fct_cohort_repeat"])
SQL["contract_c13"] = compose(nrows(
    "C13", "fct_cohort_repeat",
    "SELECT cohort_month, first_order_experience FROM fct_cohort_repeat GROUP BY 1, 2 "
    "HAVING count(DISTINCT cohort_customers) > 1"), ["fct_cohort_repeat"])
SQL["contract_c14"] = compose(nrows(
    "C14", "fct_cohort_repeat",
    "SELECT cohort_month, first_order_experience, max(period_index) - min(period_index) + 1 AS expected, "
    "count(*) AS actual FROM fct_cohort_repeat GROUP BY 1, 2 HAVING expected <> actual"),
    ["fct_cohort_repeat"])

SQL["contract_c15"] = compose(recon(
    "C15", "contribution_margin", "SELECT sum(contribution_margin) FROM fct_order_items",
    "SELECT sum(realised_revenue - cogs - net_shipping_cost) FROM fct_order_items", 1.0),
    ["fct_order_items"])
SQL["contract_c16"] = compose(recon(
    "C16", "realised_revenue", "SELECT sum(realised_revenue) FROM fct_order_items",
    "SELECT sum(net_revenue - refund_amount) FROM fct_order_items", 1.0),
    ["fct_order_items"])
SQL["contract_c17"] = compose(recon(
    "C17", "net_revenue", "SELECT sum(net_revenue) FROM fct_order_items",
    "SELECT sum(gross_revenue - discount_amount) FROM fct_order_items", 1.0),
    ["fct_order_items"])
SQL["contract_c18"] = compose(recon(
    "C18", "net_shipping_cost", "SELECT sum(net_shipping_cost) FROM fct_order_items",
    "SELECT sum(shipping_cost - shipping_fee_charged) FROM stg_orders", 5.0),
    ["fct_order_items", "stg_orders"])
SQL["contract_c19"] = compose(cnt("C19", "order_item_economics", "order_item_economics",
                                  "NOT is_restocked AND cogs_recovered <> 0"),
                              ["order_item_economics"])
SQL["contract_c20"] = compose(cnt(
    "C20", "fct_channel_payback", "fct_channel_payback",
    "abs(cumulative_margin_net_of_cac - (cumulative_contribution_margin - acquisition_spend)) > 0.01"),
    ["fct_channel_payback"])
SQL["contract_c21"] = compose(cnt("C21", "fct_fulfilment_daily", "fct_fulfilment_daily",
                                  "on_time_orders + late_orders <> orders"),
                              ["fct_fulfilment_daily"])
SQL["contract_c22"] = compose(U.join(
    recon("C22", f"{m}.{c}", "SELECT sum(net_revenue) FROM fct_order_items",
          f"SELECT sum({c}) FROM {m}", 1.0)
    for m, c in [("dim_product", "net_revenue"), ("dim_customer", "lifetime_net_revenue"),
                 ("fct_discount_bands", "net_revenue")]),
    ["fct_order_items", "dim_product", "dim_customer", "fct_discount_bands"])
SQL["contract_c23"] = compose(U.join(
    recon("C23", f"{m}.contribution_margin", "SELECT sum(contribution_margin) FROM fct_order_items",
          f"SELECT sum(contribution_margin) FROM {m}", 1.0)
    for m in ["dim_product", "fct_discount_bands"]),
    ["fct_order_items", "dim_product", "fct_discount_bands"])
SQL["contract_c24"] = compose(cnt(
    "C24", "dim_customer.orders",
    "(SELECT c.orders, f.n FROM dim_customer c LEFT JOIN (SELECT customer_id, count(DISTINCT order_id) AS n "
    "FROM fct_order_items GROUP BY 1) f ON f.customer_id = c.customer_id)",
    "orders <> coalesce(n, 0)"), ["dim_customer", "fct_order_items"])
SQL["contract_c25"] = compose(cnt("C25", "dim_customer", "dim_customer",
                                  "orders > 0 AND cohort_month IS NULL"), ["dim_customer"])
SQL["contract_c26"] = compose(cnt(
    "C26", "fct_order_items.order_date",
    "fct_order_items CROSS JOIN (SELECT min(order_date) AS lo, max(order_date) AS hi FROM stg_orders) b",
    "order_date < lo OR order_date > hi"), ["fct_order_items", "stg_orders"])

SQL["contract_line_identities"] = compose(U.join([
    cnt("C15", "contribution_margin.lines", "fct_order_items",
        "abs(contribution_margin - (realised_revenue - cogs - net_shipping_cost)) > 0.01"),
    cnt("C16", "realised_revenue.lines", "fct_order_items", "realised_revenue <> net_revenue - refund_amount"),
    cnt("C17", "net_revenue.lines", "fct_order_items", "net_revenue <> gross_revenue - discount_amount"),
    cnt("C18", "net_shipping_cost.orders", "order_freight", "abs(allocated - freight) > 0.005 * n"),
    cnt("C18", "net_shipping_cost.orders_without_lines", "order_freight", "n IS NULL AND freight <> 0"),
]).replace("order_freight", "(SELECT * FROM (SELECT order_id, shipping_cost - shipping_fee_charged AS freight "
           "FROM stg_orders) LEFT JOIN (SELECT order_id, count(*) AS n, sum(net_shipping_cost) AS allocated "
           "FROM fct_order_items GROUP BY order_id) USING (order_id))"), ["fct_order_items", "stg_orders"])


def _orphans(child: str, key: str, parent: str) -> str:
    return nrows("T10", f"{child}.{key}", f"SELECT {key} FROM stg_{child} ANTI JOIN stg_{parent} USING ({key})")


def _repeated(child: str, key: str) -> str:
    return nrows("T10", f"{child}.{key}.repeated", f"SELECT {key} FROM stg_{child} GROUP BY {key} HAVING count(*) > 1")


SQL["contract_staged_orphans"] = compose(U.join([
    _orphans("order_items", "order_id", "orders"), _orphans("order_items", "product_id", "products"),
    _orphans("orders", "customer_id", "customers"), _orphans("returns", "order_item_id", "order_items"),
    _repeated("returns", "order_item_id"), _repeated("order_items", "order_item_id"),
    _repeated("orders", "order_id"), _repeated("customers", "customer_id"), _repeated("products", "product_id"),
]), ["stg_order_items", "stg_orders", "stg_customers", "stg_products", "stg_returns"])

SQL["contract_c27"] = compose(U.join(
    f"SELECT 'C27' AS contract, '{m}' AS subject, count(*) AS rows, 0::BIGINT AS differing_rows, true AS ok FROM {m}"
    for m in PUBLISHED), list(PUBLISHED))

SQL["schema_contract"] = compose(U.join(
    f"SELECT 'C28' AS contract, '{m}' AS subject, {n}::BIGINT AS columns, 0::BIGINT AS mismatches, "
    f"0::BIGINT AS unresolved_metrics, count(*) AS rows, true AS ok FROM {m}"
    for m, n in COLUMNS.items()), list(PUBLISHED))


def same(mart: str, extra: str = "") -> str:
    return f"SELECT '{mart}' AS mart, count(*) AS rows, CAST(0 AS BIGINT) AS differing_rows,{extra} true AS ok FROM {mart}"


SQL["restated_marts"] = compose(U.join(same(m) for m in PUBLISHED), list(PUBLISHED))
_JOINED = ["dim_customer", "fct_fulfilment_daily", "fct_cohort_repeat", "fct_channel_payback"]
SQL["colocated_marts"] = compose(U.join(same(m, " CAST(0 AS BIGINT) AS shuffles,") for m in _JOINED), _JOINED)

SQL["contract_c27_buckets"] = compose("""
SELECT 'C27' AS contract, f.order_item_id, f.quantity + x.more AS quantity, CAST(1 - 2 * x.more AS BIGINT) AS surplus,
       CAST(1 AS BIGINT) AS buckets_read
FROM fct_order_items f, (VALUES (0), (1)) x(more)
WHERE f.order_item_id = (SELECT max(order_item_id) FROM fct_order_items)""", ["fct_order_items"])

_BROKEN = [("orders", "order_date", "not date", "raw_orders", "order_id % 97 = 0"),
           ("order_items", "quantity", "not int", "raw_order_items", "order_id % 101 = 0"),
           ("order_items", "unit_price", "blank", "raw_order_items", "order_id % 103 = 0"),
           ("customers", None, "not the contract''s columns", "raw_customers", "customer_id % 53 = 0"),
           ("products", "unit_cost", "not decimal(12,2)", "raw_products", "product_id % 31 = 0")]


def _held(source: str, column, reason: str, frm: str, where: str) -> str:
    name = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return (f"SELECT * FROM (SELECT '{source}' AS source, {name} AS \"column\", '{reason}' AS reason, "
            f"count(*) AS rows FROM {frm} WHERE {where}) WHERE rows > 0")


def _sound(source: str) -> str:
    broken = " OR ".join(w for s, _, _, _, w in _BROKEN if s == source) or "false"
    return (f"SELECT '{source}' AS source, CAST(NULL AS VARCHAR) AS \"column\", 'sound' AS reason, "
            f"count(*) FILTER (WHERE NOT coalesce({broken}, false)) AS rows FROM raw_{source}")


SQL["quarantine_counts"] = compose(U.join([*(_held(*x) for x in _BROKEN), *map(_sound, SOURCES)]),
                                   [f"raw_{s}" for s in SOURCES])

SQL["resumed_build"] = compose(U.join(
    f"SELECT '{m}' AS mart, CAST({1 if i < 3 else 2} AS BIGINT) AS run, count(*) AS rows FROM {m}"
    for i, m in enumerate(PUBLISHED)), list(PUBLISHED))
