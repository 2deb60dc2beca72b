import datetime as dt
import json
from decimal import Decimal

import builders as b
from pyspark.sql import functions as F

from bazaar.plans import gold, governance, incremental, reports, silver, staging


def staged(spark, docs):
    return staging.order_lines(b.orders(spark, docs), b.customers(spark, b.CUSTOMERS), b.products(spark, b.PRODUCTS))


def reasons(frame, key):
    return {r[key]: r.reason_code for r in frame.collect()}


def test_every_defect_gets_its_first_reason(spark):
    docs = [
        b.order("ok"),
        b.order("no_customer", customer_id="", currency="AZM"),
        b.order("null_customer", customer_id=None),
        b.order("azm", currency="AZM", order_ts="2019-06-15T00:00:00Z"),
        b.order("no_currency", currency=None),
        b.order("spaces", currency=" usd "),
        b.order("old", order_ts="2019-06-15T00:00:00Z"),
        b.order("no_price", {"unit_price": None}),
        b.order("blank_price", {"unit_price": ""}),
        b.order("minus", {"unit_price": -1, "quantity": 0}),
        b.order("comma", {"unit_price": "2,238.04"}),
        b.order("zero", {"quantity": 0}),
        b.order("below_zero", {"quantity": -2}),
        b.order("null_quantity", {"quantity": None}),
        b.order("who", customer_id="C9999"),
        b.order("what", {"product_id": "P9999"}),
        b.order("rejected_product", {"product_id": "P58"}),
        b.order("nothing", items=[]),
        b.order("null_items", items=None),
    ]
    found = reasons(staged(spark, docs), "order_id")
    assert found == {
        "ok": None, "no_customer": "missing_customer_id", "null_customer": "missing_customer_id",
        "azm": "unsupported_currency", "no_currency": None, "spaces": None, "old": "implausible_order_ts",
        "no_price": "missing_unit_price", "blank_price": "missing_unit_price", "minus": "negative_unit_price",
        "comma": None, "zero": "invalid_quantity", "below_zero": "invalid_quantity", "null_quantity": None,
        "who": "unknown_customer", "what": "unknown_product", "rejected_product": None,
    }


def test_duplicate_orders_lose_all_lines_but_the_latest_version(spark):
    two = [{"product_id": "P1", "quantity": n, "unit_price": 1} for n in (1, 2)]
    docs = [
        b.order("twice", items=two),
        b.order("twice", items=two),
        b.order("versions", updated_at="2026-06-01T09:00:00Z", customer_id=""),
        b.order("versions", updated_at="2026-06-02T09:00:00Z"),
    ]
    rows = [(r.order_id, r.line_number, r.reason_code) for r in staged(spark, docs).collect()]
    assert sorted(rows, key=str) == [
        ("twice", 1, "duplicate_order"), ("twice", 1, None), ("twice", 2, "duplicate_order"), ("twice", 2, None),
        ("versions", 1, "duplicate_order"), ("versions", 1, None),
    ]


def test_customers_and_products(spark):
    customers = staging.customers(b.customers(spark, b.CUSTOMERS))
    found = sorted((r.customer_id, r.segment, r.reason_code) for r in customers.filter("reason_code is not null").collect())
    assert found == [("", "SME", "missing_customer_id"), ("C104", "old", "duplicate_customer_snapshot")]
    products = staging.products(b.products(spark, b.PRODUCTS))
    found = {(r.product_id, r.unit_price, r.category): r.reason_code for r in products.collect()}
    assert found == {
        ("P1", Decimal("1010.5"), "Grocery"): None,
        ("P42", Decimal(5), "Beauty"): "duplicate_product",
        ("P42", Decimal(6), "Beauty"): None,
        ("P58", Decimal(-5), "Beauty"): "negative_unit_price",
        ("P121", Decimal(5), "Beauty"): "unsupported_currency",
        ("P77", Decimal(5), "Uncategorized"): None,
        ("P78", None, "Sport"): "missing_unit_price",
        ("", Decimal(1), "Sport"): "missing_product_id",
    }
    dim = {r.product_id: (r.list_price, r.list_currency, r.has_catalog_issue) for r in gold.dim_product(products).collect()}
    assert dim == {
        "P1": (Decimal("1010.5"), "AZN", False), "P42": (Decimal(6), "USD", False), "P58": (None, "USD", True),
        "P121": (Decimal(5), None, True), "P77": (Decimal(5), "EUR", False), "P78": (None, "EUR", True),
    }


def test_quarantine_keeps_the_row(spark):
    rejects = silver.order_lines_rejected(staged(spark, [b.order("x", customer_id=None, currency="AZM")])).collect()
    (row,) = rejects
    doc = json.loads(row.payload)
    assert (row.source, row.reason_code, doc["order_id"], doc["customer_id"]) == ("silver_order_lines", "missing_customer_id", "x", None)
    assert set(doc) == {*staging.ORDER_LINE, "reason_code"}


EVENTS = [
    b.event("E1", "o1", "CREATED", "2026-06-01T00:00:00Z", "c"),
    b.event("E1", "o1", "CREATED", "2026-06-01T00:00:00Z", "c", ingested_at="2026-06-05T00:00:00Z"),
    b.event("E2", "o1", "DELIVERED", "2026-06-03T00:00:00Z"),
    b.event("E3", "o1", "SHIPPED", "2026-06-02T00:00:00Z"),
    b.event("E4", "o2", None, "2026-06-02T00:00:00Z", "d"),
    b.event("E5", "nobody", "CREATED", "2026-06-02T00:00:00Z", "c"),
    b.event("", "o1", "CREATED", "2026-06-02T00:00:00Z", "c"),
    b.event("E6", "o4", "CREATED", "2026-06-02T00:00:00Z", "c"),
]
DOCS = [b.order("o1"), b.order("o2", status="SHIPPED"), b.order("o3"), b.order("o4"), b.order("o5", customer_id="")]


def test_status_reconciliation(spark):
    events = staging.order_events(b.events(spark, EVENTS), b.orders(spark, DOCS))
    assert sorted((r.event_id, r.reason_code) for r in events.filter("reason_code is not null").collect()) == [
        ("", "missing_event_id"), ("E5", "unknown_order"),
    ]
    assert events.count() == 7
    found = silver.status_reconciliation(staged(spark, DOCS), silver.status_history(events)).collect()
    assert {r.order_id: (r.final_status, r.reconciliation_status) for r in found} == {
        "o1": ("DELIVERED", "status_mismatch"), "o2": ("SHIPPED", "tombstone_erasure"),
        "o3": ("CREATED", "no_events_for_order"), "o4": ("CREATED", "match"), "o5": ("CREATED", "no_events_for_order"),
    }


def test_fact_rates_versions_and_flags(spark):
    docs = [
        b.order("weekend", currency="USD", order_ts="2026-06-07T20:30:00Z"),  # a Monday in the local zone
        b.order("before", currency="EUR", order_ts="2026-05-01T00:00:00Z"),
        b.order("base", order_ts="2026-06-11T00:00:00Z", status="REFUNDED"),
        b.order("outside", order_ts="2027-06-11T00:00:00Z", currency=None),
    ]
    lines = silver.order_lines(staged(spark, docs))
    rates = gold.fx_rates(b.fx(spark, {"2026-06-05": {"USD": 1.7, "EUR": 1.9}, "2026-06-08": {"USD": 1.8}, "2026-06-09": {"USD": 2}}))
    customers = gold.dim_customer(silver.customers(staging.customers(b.customers(spark, b.CUSTOMERS))))
    status = silver.status_reconciliation(staged(spark, docs), silver.status_history(staging.order_events(b.events(spark, []), b.orders(spark, docs))))
    fact = gold.fct_order_lines(lines, rates, status, gold.calendar(spark, "2026-01-01", "2026-12-31"), customers)
    found = {r.order_id: r for r in fact.join(customers, "customer_key", "left").collect()}
    assert found["weekend"].gross_amount_azn == Decimal("37.8")
    assert (found["weekend"].order_date_key, found["weekend"].segment) == (20260608, "SME")
    assert (found["before"].rate_azn, found["before"].gross_amount_azn) == (None, None)
    assert (found["base"].segment, found["base"].is_recognized, found["base"].rate_azn) == ("Corporate", False, 1)
    assert (found["outside"].order_date_key, found["outside"].rate_azn) == (None, None)
    schema = {f.name: f.dataType.simpleString() for f in fact.schema}
    assert schema["gross_amount_azn"] == "decimal(38,12)"


def test_calendar(spark):
    (row,) = gold.calendar(spark, "2026-06-07", "2026-06-07").collect()
    assert (row.date_key, row.month_name, row.day_of_week, row.is_weekend) == (20260607, "June     ", 7, True)


def status_events(spark, rows):
    return spark.createDataFrame(rows, "order_id string, new_status string, event_ts timestamp")


def test_funnel_and_lead_time(spark):
    at = lambda h: dt.datetime(2026, 6, 1) + dt.timedelta(hours=h)
    rows = [("a", "CREATED", at(0)), ("a", "CREATED", at(1)), ("a", "DELIVERED", at(10)), ("b", "CREATED", at(0)), ("b", "DELIVERED", at(20)), ("c", "CREATED", at(0)), ("c", "CANCELLED", at(5)), ("d", "DELIVERED", at(3))]
    funnel = {r.stage: (r.orders_reached, float(r.pct) if r.pct is not None else None) for r in reports.status_funnel(status_events(spark, rows)).collect()}
    assert funnel == {"CREATED": (3, None), "DELIVERED": (3, 100.0), "CANCELLED": (1, 33.33), "REFUNDED": (0, 0.0)}
    (lead,) = reports.delivery_lead_time(status_events(spark, rows)).collect()
    assert (lead.month, lead.p50_hours, lead.p90_hours, lead.delivered_order_count) == (dt.date(2026, 6, 1), 15.0, 19.0, 2)


def test_top_customers_share_a_rank(spark):
    fact = spark.createDataFrame([(f"k{n}", Decimal(v), True) for n, v in enumerate([5, 9, 9, 1, 3])], "customer_key string, gross_amount_azn decimal(38,12), is_recognized boolean")
    names = spark.createDataFrame([(f"k{n}", f"c{n}", "x") for n in range(5)], "customer_key string, customer_id string, full_name string")
    found = [(r.customer_id, r.revenue_rank, float(r.pct_of_total_revenue)) for r in reports.top_customers(fact, names, 3).collect()]
    assert found == [("c1", 1, 33.33), ("c2", 1, 33.33), ("c0", 3, 18.52)]


def history(spark, rows):
    full = [(e, o, "u", None, s, dt.datetime(2026, 6, d), "x", None) for e, o, s, d in rows]
    return spark.createDataFrame(full, "event_id string, order_id string, op string, old_status string, new_status string, event_ts timestamp, source string, reason_code string")


def test_row_watermark_drops_late_events_unless_kept(spark):
    target = silver.status_history(history(spark, [("E1", "o1", "CREATED", 1), ("E3", "o1", "SHIPPED", 3)]))
    now = history(spark, [("E1", "o1", "CREATED", 1), ("E2", "o1", "PACKED", 2), ("E3", "o1", "SHIPPED", 3), ("E3b", "o2", "CREATED", 3), ("E4", "o1", "DELIVERED", 4)])
    ids = lambda df: sorted(r.event_id for r in df.collect())
    assert ids(incremental.status_history(now, target)) == ["E1", "E3", "E4"]
    assert ids(incremental.status_history(now, target, late="keep")) == ["E1", "E2", "E3", "E3b", "E4"]
    assert ids(incremental.status_history(now, target, full_refresh=True)) == ["E1", "E2", "E3", "E3b", "E4"]


def test_removed_line_stays_until_a_full_refresh(spark):
    two = [{"product_id": "P1", "quantity": n, "unit_price": 1} for n in (1, 2)]
    first = staged(spark, [b.order("o1", items=two), b.order("o2")])
    target = silver.order_lines(first)
    later = staged(spark, [b.order("o1", items=two), b.order("o1", items=two[:1], updated_at="2026-06-05T00:00:00Z"), b.order("o2")])
    keys = lambda df: sorted((r.order_id, r.line_number) for r in df.collect())
    assert keys(incremental.order_lines(later, target)) == [("o1", 1), ("o1", 2), ("o2", 1)]
    assert keys(incremental.order_lines(later, target, full_refresh=True)) == [("o1", 1), ("o2", 1)]


def test_erasure_and_masking(spark):
    customers = gold.dim_customer(silver.customers(staging.customers(b.customers(spark, b.CUSTOMERS))))
    masked = governance.masked_customers(customers)
    assert masked.filter(F.col("full_name").startswith("Name")).count() == 0
    gone = spark.createDataFrame([("C1",)], "customer_id string")
    layers = governance.erase_layers({"dim": customers, "plain": spark.range(3)}, gone)
    assert {r.customer_id for r in layers["dim"].collect()} == {"C2", "C104"}
    assert layers["plain"].count() == 3


def test_missing_table_of_rates_is_visible(spark):
    bounds = spark.createDataFrame([(dt.date(2026, 6, 4), dt.date(2026, 6, 9))], "since date, until date")
    from bazaar.sources import landed

    days = landed.days_without_rates(b.fx(spark, {"2026-06-05": {}, "2026-06-08": {}}), bounds)
    assert sorted(str(r.day) for r in days.collect()) == ["2026-06-04", "2026-06-06", "2026-06-07"]


