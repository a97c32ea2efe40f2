"""Rows of the six input contracts, as the raw extracts hold them."""

from __future__ import annotations


def raw_sources(spark, **tables):
    """Build all-string raw extracts (the CSV contract) from lists of dicts."""
    from ledgerwalk.sources.contracts import RAW_COLUMNS, RAW_CONTRACTS
    from ledgerwalk.sources.extracts import Sources

    frames = {}
    for name, cols in RAW_COLUMNS.items():
        rows = tables.get(name, [])
        data = [tuple(None if r.get(c) is None else str(r.get(c)) for c in cols) for r in rows]
        frames[name] = spark.createDataFrame(data, RAW_CONTRACTS[name])
    return Sources.from_dict(frames)


def customer(cid, signup="2024-01-05", channel="Organic Search", **kw):
    return {"customer_id": cid, "signup_date": signup, "acquisition_channel": channel,
            "country": "UK", "region": "North", "city": "Leeds", "marketing_opt_in": "1", **kw}


def product(pid, cost="10.00", price="20.00", category="Apparel", **kw):
    return {"product_id": pid, "sku": "S-" + pid, "product_name": "P " + pid, "category": category,
            "subcategory": "Sub", "brand": "B", "unit_cost": cost, "list_price": price,
            "weight_kg": "1.00", **kw}


def order(oid, cid, date="2024-01-10", seq=1, shipped=True, promised="2024-01-13",
          ship_date="2024-01-11", delivered="2024-01-12", fee="0.00", cost="0.00", **kw):
    return {"order_id": oid, "customer_id": cid, "order_date": date, "order_channel": "Web",
            "order_sequence": str(seq), "is_shipped": "1" if shipped else "0",
            "fulfilment_centre": "FC-North" if shipped else "Store Pickup",
            "carrier": "Swiftline" if shipped else "", "promised_delivery_date": promised if shipped else "",
            "shipped_date": ship_date if shipped else "", "delivered_date": delivered if shipped else "",
            "shipping_fee_charged": fee, "shipping_cost": cost, "payment_method": "Card",
            "promo_code": "", "order_status": "Delivered", **kw}


def item(iid, oid, pid, qty=1, price="10.00", discount="0.00"):
    return {"order_item_id": iid, "order_id": oid, "product_id": pid, "quantity": str(qty),
            "unit_price": price, "discount_amount": discount}


def ret(rid, iid, date="2024-01-20", qty=1, reason="Changed mind", restocked=True, refund="10.00"):
    return {"return_id": rid, "order_item_id": iid, "return_date": date,
            "quantity_returned": str(qty), "return_reason": reason,
            "restocked": "1" if restocked else "0", "refund_amount": refund}


def spend(date, channel, amount):
    return {"spend_date": date, "channel": channel, "campaign": "C", "spend": amount,
            "impressions": "10", "clicks": "1"}
