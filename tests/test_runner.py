import builders as b
import pytest
from pyspark.sql import functions as F

from bazaar.operators.quality import ChecksFailed
from bazaar.plans import runner

CALENDAR = ("2026-01-01", "2026-12-31")
CUSTOMERS = [row for row in b.CUSTOMERS if row[0]]


def feeds(spark, docs, events=()):
    return {
        "orders": b.orders(spark, docs),
        "customers": b.customers(spark, CUSTOMERS),
        "products": b.products(spark, b.PRODUCTS),
        "events": b.events(spark, list(events) or [b.event("E0", "none", "CREATED", "2026-06-01T00:00:00Z")]),
        "fx_rates": b.fx(spark, {"2026-06-05": {"USD": 1.7}}),
    }


def test_intervals_gate_and_versions(spark, tmp_path):
    lake = runner.Lake(spark, str(tmp_path), "t_")
    now = F.current_timestamp()

    def run(docs, since, until, **options):
        return runner.run_interval(lake, feeds(spark, docs), since, until, now, CALENDAR, **options)

    def lines():
        return sorted((r.order_id, r.quantity) for r in lake.table("gold.fct_order_lines").collect())

    run([b.order("o1"), b.order("o2")], "2026-06-01", "2026-06-02")
    assert lines() == [("o1", 2), ("o2", 2)]

    # The same interval again replaces its documents instead of doubling them; o2 is gone from the source.
    run([b.order("o1", {"quantity": 5})], "2026-06-01", "2026-06-02")
    assert lake.table("bronze.orders").count() == 1
    assert lines() == [("o1", 5)]

    # The next interval is incremental.
    run([b.order("o3", updated_at="2026-06-02T09:00:00Z")], "2026-06-02", "2026-06-03")
    assert lake.table("bronze.orders").count() == 2
    assert lines() == [("o1", 5), ("o3", 2)]

    # A line without an amount fails the gate of gold; what was published stays as it was.
    early = b.order("o4", currency="USD", order_ts="2026-06-01T00:00:00Z", updated_at="2026-06-03T09:00:00Z")
    with pytest.raises(ChecksFailed, match="not_null_gross_amount_azn=1"):
        run([early], "2026-06-03", "2026-06-04")
    assert lines() == [("o1", 5), ("o3", 2)]
    assert lake.table("silver.order_lines").count() == 3 and not lake.pending

    # Nothing of the failed gold layer comes back with the next run; with a rate for its day the line is fine there.
    runner.land(lake, {"orders": b.orders(spark, [b.order("o5", updated_at="2026-06-04T09:00:00Z")])}, "2026-06-04", "2026-06-05")
    lake.publish()
    assert lines() == [("o1", 5), ("o3", 2)]


def test_a_run_rewrites_only_what_it_touches(spark, tmp_path):
    lake = runner.Lake(spark, str(tmp_path), "p_")
    now = F.current_timestamp()
    docs = [b.order("o1"), b.order("o2", order_ts="2026-07-03T09:00:00Z"), b.order("o3")]
    events = [b.event("E1", "o9", "SHIPPED", "2026-06-02T00:00:00Z")]  # its order comes later
    runner.run_interval(lake, feeds(spark, docs, events), "2026-06-01", "2026-06-02", now, priced=False)
    assert lake.table("silver.order_status_history").count() == 0 and lake.table("quarantine.order_events").count() == 1
    later = [b.order("o9", updated_at="2026-06-02T09:00:00Z"), b.order("o1", {"quantity": 9}, updated_at="2026-06-02T10:00:00Z")]
    moved = runner.run_interval(lake, {"orders": b.orders(spark, later)}, "2026-06-02", "2026-06-03", now, priced=False)
    assert set(moved["bronze.orders"]) - {"none"} == {"2026-06"} and "bronze.customers" not in moved
    assert moved["silver.order_lines"] == moved["gold.fct_order_lines"] == ("2026-06",)
    got = {r.order_id: r.quantity for r in lake.table("gold.fct_order_lines").collect()}
    assert got == {"o1": 9, "o2": 2, "o3": 2, "o9": 2}
    assert [r.event_id for r in lake.table("silver.order_status_history").collect()] == ["E1"]
    assert lake.table("quarantine.order_events").count() == 0
    assert {r.reason_code for r in lake.table("quarantine.order_lines").collect()} == {"duplicate_order"}
    plan = lake.table("gold.fct_order_lines").filter("_part = '2026-07'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    # Replaced versions can go: nothing that is left changes.
    assert lake.vacuum("silver.order_lines") + lake.vacuum("gold.dim_date") > 0
    assert lake.table("silver.order_lines").count() == 4 and lake.table("gold.dim_date").count() > 0


def test_a_load_without_rows_is_emptied_and_broken_documents_are_kept(spark, tmp_path):
    lake = runner.Lake(spark, str(tmp_path), "l_")
    first = feeds(spark, [b.order("o1")])
    loads = {r[0] for r in first["events"].select("_load_id").distinct().collect()}
    broken = first["orders"].withColumn("payload", F.lit('{"order_id": "o')).withColumn("_record_id", F.lit("x"))
    runner.land(lake, first | {"orders": first["orders"].unionByName(broken)}, "2026-06-01", "2026-06-02")
    lake.publish()
    assert lake.table("quarantine.records").select("reason_code").collect() == [("malformed_json",)]
    runner.land(lake, {"events": first["events"].limit(0)}, "2026-06-01", "2026-06-02", {"events": sorted(loads)})
    lake.publish()
    assert lake.table("bronze.events").count() == 0 and lake.table("bronze.customers").count() > 0


def test_empty_bronze_stops_the_run(spark, tmp_path):
    lake = runner.Lake(spark, str(tmp_path), "e_")
    with pytest.raises(ChecksFailed, match="bronze.orders.row_count=1"):
        runner.run_interval(lake, feeds(spark, []), "2026-06-01", "2026-06-02", F.current_timestamp(), CALENDAR)
    assert not lake.has("silver.order_lines") and not lake.has("bronze.orders") and not lake.pending
