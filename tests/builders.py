"""Small bronze frames with the defects the feeds are known for."""

import itertools
import json

from pyspark.sql import functions as F

from bazaar.sources import landed

BASE = {
    "customer_id": "C1", "channel": "web", "currency": "AZN", "order_ts": "2026-06-01T08:30:00Z",
    "status": "CREATED", "updated_at": "2026-06-01T09:00:00Z",
    "items": [{"product_id": "P1", "quantity": 2, "unit_price": 10.5}],
}


def order(order_id, item=None, **fields):
    doc = {"order_id": order_id, **BASE, **fields}
    if item is not None:
        doc["items"] = [{**BASE["items"][0], **item}]
    return json.dumps(doc)


def event(event_id, order_id, status, at, op="u", **fields):
    return json.dumps(
        {
            "event_id": event_id, "op": op, "order_id": order_id, "old_status": None, "new_status": status,
            "event_ts": at, "ingested_at": at, "source": "order-service", **fields,
        }
    )


_batches = itertools.count()


def _numbered(spark, rows, schema, source, load):
    batch = next(_batches)  # record ids never repeat, in no batch
    df = spark.createDataFrame([(*row, f"{source}:{batch}:{n:05}") for n, row in enumerate(rows)], schema + ", _record_id string")
    return df.select(
        "*", F.lit(source).alias("_source"), F.lit("b1").alias("_batch_id"), F.lit(load).alias("_load_id"),
        F.current_timestamp().alias("_ingested_at"),
    )


def orders(spark, docs, load="orders_all"):
    return landed.promoted(_numbered(spark, [(d,) for d in docs], "payload string", "orders_api", load))


def events(spark, docs, load="events_all"):
    return _numbered(spark, [(d,) for d in docs], "payload string", "events_ndjson", load)


def customers(spark, rows, load="customers_all"):
    """Rows of (customer_id, country, segment, updated_at, snapshot_date)."""
    full = [(c, f"Name {c}", country, segment, "2024-01-01", at, snap) for c, country, segment, at, snap in rows]
    columns = "customer_id string, full_name string, country string, segment string, signup_date string, updated_at string, snapshot_date string"
    return _numbered(spark, full, columns, "customers_csv", load)


def products(spark, rows):
    """Rows of (product_id, category, unit_price, currency, updated_at)."""
    full = [(p, f"Product {p}", *rest) for p, *rest in rows]
    columns = "product_id string, product_name string, category string, unit_price string, currency string, updated_at string"
    return _numbered(spark, full, columns, "products_csv", "products")


def fx(spark, rates):
    """Mapping of day to {currency: rate}."""
    docs = [
        (d, json.dumps({"date": d, "rates": [{"currency": c, "rate_azn": r} for c, r in found.items()]}))
        for d, found in rates.items()
    ]
    return _numbered(spark, docs, "rate_date string, payload string", "fx_api", "fx_all")


CUSTOMERS = [
    ("C1", "AZE", "SME", "2026-06-01T00:00:00Z", "2026-06-01"),
    ("C1", "AZE", "Corporate", "2026-06-01T00:00:00Z", "2026-06-10"),
    ("C2", "N/A", "SME", "2026-06-01T00:00:00Z", "2026-06-01"),
    ("C2", "N/A", "SME", "2026-06-01T00:00:00Z", "2026-06-10"),
    ("C104", "TURKEY", "old", "2026-06-01T00:00:00Z", "2026-06-01"),
    ("C104", "TURKEY", "new", "2026-06-01T05:00:00Z", "2026-06-01"),
    ("", "Georgia", "SME", "2026-06-01T00:00:00Z", "2026-06-01"),
]
PRODUCTS = [
    ("P1", "Grocery", "1,010.50", "azn", "2026-01-01T00:00:00Z"),
    ("P42", "Beauty", "5", "USD", "2026-01-01T00:00:00Z"),
    ("P42", "Beauty", "6", "USD", "2026-01-02T00:00:00Z"),
    ("P58", "Beauty", "-5", "USD", "2026-01-01T00:00:00Z"),
    ("P121", "Beauty", "5", "AZM", "2026-01-01T00:00:00Z"),
    ("P77", " ", "5", " EUR ", "2026-01-01T00:00:00Z"),
    ("P78", "Sport", "", "EUR", "2026-01-01T00:00:00Z"),
    ("", "Sport", "1", "EUR", "2026-01-01T00:00:00Z"),
]
