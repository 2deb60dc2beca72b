"""Runs again, rows from elsewhere, late orders, moved events, day partitions, and publishes that stop half way."""

import builders as b
import pytest
from pyspark.sql import functions as F

from bazaar.plans import layout, places, runner
from bazaar.session import workspace
from bazaar.sources import sinks

CUSTOMERS = [row for row in b.CUSTOMERS if row[0]]
VOLATILE = ("_ingested_at", "quarantined_at", "_record_id", "_batch_id", "_run", "quarantine_id")
TABLES = [t for t in runner.PARTED if t != "bronze.orders"] + ["bronze.orders", "bronze.events", "gold.dim_date", "gold.dim_customer", "gold.monthly_revenue"]


def lake_of(spark, name, **options):
    root = workspace(spark, name)
    return runner.Lake(spark, root, f"{name}_{root[-6:]}_", **options)


def feeds(spark, docs, events=None, whole=True):
    out = {"orders": b.orders(spark, docs)}
    if events is not None:
        out["events"] = b.events(spark, events)
    if whole:
        out |= {"customers": b.customers(spark, CUSTOMERS), "products": b.products(spark, b.PRODUCTS), "fx_rates": b.fx(spark, {"2026-06-05": {"USD": 1.7}})}
    return out


def run(lake, feed, since, until, **options):
    return runner.run_interval(lake, feed, since, until, F.current_timestamp(), priced=False, **options)


def content(lake, name):
    rows = lake.table(name)
    rows = rows.select(*[c for c in sorted(rows.columns) if c not in VOLATILE])
    return sorted(map(str, rows.collect()))


def same_lake(one, other, tables=TABLES):
    for name in tables:
        assert content(one, name) == content(other, name), name


FIRST = [
    b.order("o1"), b.order("o2"), b.order("o3", order_ts="2026-05-30T10:00:00Z"), b.order(None, customer_id="nobody"), b.order(None, {"quantity": 3}, customer_id="nobody", updated_at="2026-06-01T10:00:00Z"),
    b.order("o5", customer_id="nobody"), b.order("o6", updated_at=None),
]
EVENTS = [
    b.event("E1", "o1", "PACKED", "2026-06-01T00:00:00Z"), b.event("E2", "o1", "SHIPPED", "2026-06-02T00:00:00Z"), b.event("E3", "o2", "PACKED", "2026-06-01T00:00:00Z"),
    b.event("E4", "o9", "PACKED", "2026-06-01T00:00:00Z"), b.event("E5", None, "PACKED", "2026-06-01T00:00:00Z"), b.event(None, "o1", "PACKED", "2026-06-01T00:00:00Z"),
]
SECOND = [b.order("o1", {"quantity": 7}), b.order("o3", order_ts="2026-05-30T10:00:00Z"), b.order(None, customer_id="nobody"), b.order("o7"), b.order("o6", updated_at=None)]
LATER = [EVENTS[0], EVENTS[3], b.event("E3", "o2", "PACKED", "2026-06-01T00:00:00Z"), b.event("E6", "o7", "PACKED", "2026-07-01T00:00:00Z")]


def test_an_interval_again_gives_the_lake_of_a_full_refresh(spark):
    """o2, o5 and a document without id left the feed, o1 changed, o7 came; E2 and E5 left, o2's event has no order now."""
    lake, fresh = lake_of(spark, "again"), lake_of(spark, "fresh")
    run(lake, feeds(spark, FIRST, EVENTS), "2026-06-01", "2026-06-02")
    before = content(lake, "quarantine.order_lines")
    run(lake, feeds(spark, FIRST, EVENTS), "2026-06-01", "2026-06-02")
    assert content(lake, "quarantine.order_lines") == before and lake.table("bronze.changed_orders").count() == 0
    moved = run(lake, feeds(spark, SECOND, LATER), "2026-06-01", "2026-06-02")
    run(fresh, feeds(spark, SECOND, LATER), "2026-06-01", "2026-06-02", full_refresh=True)
    same_lake(lake, fresh)
    assert {r.order_id for r in lake.table("gold.fct_order_lines").collect()} == {"o1", "o3", "o6", "o7"}
    assert {r.event_id for r in lake.table("silver.order_status_history").collect()} == {"E1", "E6"}
    assert "2026-06" in moved["gold.fct_order_lines"]
    run(lake, feeds(spark, SECOND, LATER), "2026-06-01", "2026-06-02", full_refresh=True)
    same_lake(lake, fresh)


def test_rows_from_outside_their_interval_are_merged(spark):
    lake = lake_of(spark, "stray", target=2)
    days = [b.order(f"a{d}", updated_at=f"2026-08-{d:02}T09:00:00Z") for d in (8, 9, 9, 9, 10)]
    run(lake, feeds(spark, days, EVENTS), "2026-08-01", "2026-09-01")
    stray = [b.order("late", updated_at="2026-08-09T11:00:00Z"), b.order("new", updated_at="2026-09-01T01:00:00Z")]
    for _ in range(2):  # the same interval again does not double the stray row
        moved = run(lake, feeds(spark, stray, whole=False), "2026-09-01", "2026-09-02")
        assert sorted(r._order_id for r in lake.table("bronze.orders").collect()) == ["a10", "a8", "a9", "a9", "a9", "late", "new"]
        assert sorted({p.split(".")[0] for p in moved["bronze.orders"]}) == ["2026-08-09", "2026-09"]
    assert {r.order_id for r in lake.table("gold.fct_order_lines").collect()} == {"a8", "a9", "a10", "late", "new"}


def test_a_late_order_reads_its_own_partitions(spark):
    lake = lake_of(spark, "late", target=1)
    days = [b.order(f"a{d}", order_ts=f"2026-08-{d:02}T08:00:00Z", updated_at=f"2026-08-{d:02}T09:00:00Z") for d in range(1, 9) for _ in range(2)]
    run(lake, feeds(spark, days, EVENTS), "2026-08-01", "2026-09-01")
    assert len(lake.partitions("bronze.orders")) >= 8
    again = b.order("a3", {"quantity": 9}, order_ts="2026-08-03T08:00:00Z", updated_at="2026-09-01T09:00:00Z")
    moved = run(lake, feeds(spark, [again], whole=False), "2026-09-01", "2026-09-02")
    part_of = {r._order_id: r._part for r in lake.table("bronze.orders").filter("_updated_at < '2026-09-01'").collect()}
    touched = spark.createDataFrame([("a3",)], "_entity string")
    where = runner.places_of(lake, touched)
    assert places.partitions(where, "bronze.orders") == sorted([part_of["a3"], "2026-09"])
    rows = runner.rows_of(lake, "bronze.orders", touched, where)
    read = {f.split("_part=")[1].split("/")[0] for f in rows.inputFiles()}
    assert read == {part_of["a3"], "2026-09"} and rows.count() == 3
    for name in ("silver.order_lines", "gold.fct_order_lines"):
        assert len(moved[name]) == 1 and moved[name][0].startswith("2026-08-03")
    assert [r.quantity for r in lake.table("gold.fct_order_lines").filter("order_id = 'a3'").collect()] == [9]


def test_a_moved_event_replaces_its_row(spark):
    lake = lake_of(spark, "moved")
    run(lake, feeds(spark, FIRST, EVENTS), "2026-06-01", "2026-06-02")
    corrected = b.events(spark, [b.event("E2", "o1", "SHIPPED", "2026-08-20T00:00:00Z")], "events_next").withColumn("_ingested_at", F.expr("current_timestamp() + interval 1 hour"))
    run(lake, {"events": corrected}, "2026-06-02", "2026-06-03")
    got = {(r.event_id, str(r.event_ts)[:10]) for r in lake.table("gold.fct_order_status_events").collect()}
    assert ("E2", "2026-08-20") in got and ("E2", "2026-06-02") not in got
    assert lake.table("silver.order_status_history").filter("event_id = 'E2'").count() == 1


def test_the_index_is_folded(spark, monkeypatch):
    monkeypatch.setattr(runner, "FOLD", 2)
    lake, plain = lake_of(spark, "fold"), lake_of(spark, "plain")
    run(lake, feeds(spark, FIRST, EVENTS), "2026-06-01", "2026-06-02")
    run(lake, feeds(spark, SECOND, LATER), "2026-06-01", "2026-06-02")
    monkeypatch.setattr(runner, "FOLD", 99)
    run(plain, feeds(spark, SECOND, LATER), "2026-06-01", "2026-06-02")
    assert len(lake.partitions("bronze.places")) <= 2
    flat = lambda x: sorted(map(str, runner.places_of(x).filter(F.size("parts") > 0).collect()))
    assert flat(lake) == flat(plain)


@pytest.mark.parametrize("stop", [0, 3])
def test_a_publish_that_stops_is_ended_by_the_next_start(spark, monkeypatch, stop):
    lake = lake_of(spark, f"stop{stop}")
    run(lake, feeds(spark, FIRST, EVENTS), "2026-06-01", "2026-06-02")
    runner.land(lake, feeds(spark, SECOND, LATER), "2026-06-01", "2026-06-02")
    lake.publish()
    runner.build_silver(lake, True)
    names = [n for n in lake.pending if lake.pending[n].key and n != "bronze.places"]
    want = {n: lake.current(n).count() for n in names}
    real, done = sinks.publish_partitions, []

    def broken(*args):
        if len(done) == stop:
            raise RuntimeError("stopped")
        done.append(args)
        real(*args)

    monkeypatch.setattr(sinks, "publish_partitions", broken)
    monkeypatch.setattr(sinks, "publish", lambda *a, f=sinks.publish: broken_plain(f, *a))

    def broken_plain(f, *args):
        if len(done) == stop:
            raise RuntimeError("stopped")
        return f(*args)

    with pytest.raises(RuntimeError):
        lake.publish()
    monkeypatch.undo()
    again = runner.Lake(spark, lake.root, lake.prefix)
    assert not sinks.journals(spark, lake.root)
    assert {n: again.table(n).count() for n in names} == want


def test_heavy_days_are_split_and_light_ones_grouped(spark):
    sizes = spark.createDataFrame([("2026-06-01", 100), ("2026-06-02", 3), ("2026-06-03", 4), ("2026-07-01", 9), ("2026-07-02", 9), ("none", 500)], "day string, n long")
    got = {r.day: (r.label, r.splits) for r in layout.planned(sizes, None, 10).collect()}
    assert got == {"2026-06-01": ("2026-06-01", 16), "2026-06-02": ("2026-06", 1), "2026-06-03": ("2026-06", 1), "2026-07-01": ("2026-07-01", 1), "2026-07-02": ("2026-07-02", 1), "none": ("none", 1)}
    known = layout.planned(sizes, None, 10)
    more = spark.createDataFrame([("2026-06-04", 2), ("2026-06-05", 2), ("2026-06-01", 1)], "day string, n long")
    assert {r.day: r.label for r in layout.planned(more, known, 10).collect()} == {"2026-06-04": "2026-06-04", "2026-06-05": "2026-06-05"}
    assert layout.within(["2026-06", "2026-06-01.0003", "2026-06-09", "2026-07", "none"], "2026-06-01", "2026-06-03") == ["2026-06", "2026-06-01.0003"]


def test_a_lake_is_arranged_anew(spark):
    """Grouped by month at first, then split into days and hash ranges, then grouped again; rows and runs stay right."""
    lake, plain = lake_of(spark, "arranged"), lake_of(spark, "unarranged")
    docs = [b.order(f"a{i}", order_ts=f"2026-08-{i % 3 + 1:02}T08:00:00Z", updated_at=f"2026-08-{i % 3 + 1:02}T09:00:00Z") for i in range(24)]
    for x in (lake, plain):
        run(x, feeds(spark, docs, EVENTS), "2026-08-01", "2026-09-01")
    lake.target = 3
    moved = runner.rearrange(lake)
    assert "2026-08" in moved["bronze.orders"] and any("." in p for p in lake.partitions("bronze.orders")) and "2026-08" not in lake.partitions("silver.order_lines")
    hidden = ("_part",)
    rows = lambda x, n: sorted(str(r) for r in x.table(n).drop(*VOLATILE, *hidden).collect())
    again = [b.order("a1", {"quantity": 5}, order_ts="2026-08-02T08:00:00Z", updated_at="2026-08-02T19:00:00Z"), b.order("a30", updated_at="2026-08-02T19:00:00Z")]
    for x in (lake, plain):
        run(x, feeds(spark, again, whole=False), "2026-08-02", "2026-08-03")
    for name in TABLES:
        assert rows(lake, name) == rows(plain, name), name
    lake.target = layout.TARGET
    runner.rearrange(lake)
    assert lake.partitions("bronze.orders") == ["2026-08"]
    for name in TABLES:
        assert rows(lake, name) == rows(plain, name), name


def test_a_lake_by_months_is_brought_to_days(spark):
    lake, plain = lake_of(spark, "months"), lake_of(spark, "days", target=2)
    run(lake, feeds(spark, FIRST, EVENTS), "2026-06-01", "2026-06-02")
    run(plain, feeds(spark, FIRST, EVENTS), "2026-06-01", "2026-06-02")
    for name in (*runner.PARTED, "bronze.fx_rates"):  # as such a lake was written before
        rows = lake.table(name).drop("_day", "_entity").withColumnRenamed("_part", "_month")
        lake.write_partitions(name, rows.withColumn("_month", F.left("_month", F.lit(7))), "_month", [])
        lake.pending[name].anew = True
    events = lake.table("bronze.events").drop("_entity", "_order_id", "_event_id")
    lake.write_partitions("bronze.events", events.select(*[c for c in events.columns if c != "_load_id"], "_load_id"), "_load_id", [])
    lake.pending["bronze.events"].anew = True
    lake.publish()
    for name in ("bronze.places", "bronze.layout", "bronze.changed_orders"):
        spark.sql(f"DROP TABLE {lake.prefix}{name}")
    lake.target = 2
    runner.rearrange(lake)
    for x in (lake, plain):
        run(x, feeds(spark, SECOND, LATER), "2026-06-01", "2026-06-02")
    hidden = ("_part", "_day")
    for name in TABLES:
        left, right = (sorted(str(sorted(r.asDict().items())) for r in x.table(name).drop(*VOLATILE, *hidden).collect()) for x in (lake, plain))
        assert left == right, name


def snapshot(day, rows):
    return [(c, country, segment, f"{day}T00:00:00Z", day) for c, country, segment in rows]


def test_snapshots_merge_into_the_dimension(spark):
    """A newest and a late snapshot, one again with other rows, and one that is emptied: as if all was built at once."""
    days = {
        "2026-05-01": [("C1", "AZE", "SME"), ("C2", "AZE", "SME"), ("C3", "AZE", "SME")],
        "2026-06-10": [("C1", "AZE", "SME"), ("C2", "AZE", "VIP")],
        "2026-06-20": [("C1", "AZE", "KEY"), ("C2", "AZE", "VIP"), ("C4", "AZE", "SME")],
        "2026-06-15": [("C1", "AZE", "SME"), ("C3", "AZE", "SME")],
    }
    docs = [b.order(f"o{i}", customer_id=f"C{i % 4 + 1}", order_ts=f"2026-06-{i + 5:02}T08:00:00Z") for i in range(20)]

    def load(day, rows):
        return {"customers": b.customers(spark, snapshot(day, rows), f"customers_{day}")}

    def both(steps):
        lake, whole = lake_of(spark, "merge"), lake_of(spark, "built")
        for n, (day, rows) in enumerate(steps):
            feed = load(day, rows) | (feeds(spark, docs, EVENTS, whole=False) | {"products": b.products(spark, b.PRODUCTS), "fx_rates": b.fx(spark, {"2026-06-05": {"USD": 1.7}})} if n == 0 else {})
            options = {"checked": ("orders",), "loads": {"customers": [f"customers_{day}"]}}
            run(lake, feed, "2026-06-01", "2026-06-02", **options)
            if n < len(steps) - 1:
                runner.land(whole, feed, "2026-06-01", "2026-06-02", options["loads"])
                whole.publish()
        run(whole, feed, "2026-06-01", "2026-06-02", full_refresh=True, **options)
        return lake, whole

    again = [("C1", "AZE", "SME"), ("C2", "TURKEY", "VIP"), ("C4", "AZE", "SME")]
    lake, whole = both([*days.items(), ("2026-06-10", again), ("2026-06-20", [])])
    for name in ("gold.dim_customer", "gold.fct_order_lines", "silver.customers", "silver.order_lines", "quarantine.order_lines"):
        assert content(lake, name) == content(whole, name), name
    assert not lake.table("bronze.changed_snapshots").count()
    # Only the bucket of the one customer that changes is written.
    moved = run(lake, load("2026-06-25", [("C1", "AZE", "SME"), ("C3", "AZE", "NEW")]), "2026-06-25", "2026-06-26", checked=("orders",))
    changed = {r.customer_id for r in lake.table("gold.changed_customers").collect()}
    assert changed == {"C3"} and len(moved["gold.dim_customer"]) == 1


def test_crowded_partitions_are_compacted(spark, conf):
    lake = lake_of(spark, "crowded")
    rows = spark.range(400).selectExpr("id", "if(id % 2 = 0, 'a', 'b') as _part")
    lake.write_partitions("gold.numbers", rows.filter("_part = 'a'").repartition(9).hint("rebalance").unionByName(rows.filter("_part = 'b'").coalesce(1)), "_part", [])
    path = lake.pending["gold.numbers"].path
    rows.filter("_part = 'a'").repartition(9).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_part").parquet(path)
    lake.publish()
    before = lake.table("gold.numbers").count()
    assert runner.compact(lake, "gold.numbers") == ["a"] and lake.table("gold.numbers").count() == before == 400
    assert len(lake.table("gold.numbers").filter("_part = 'a'").inputFiles()) < 4 and runner.compact(lake, "gold.numbers") == []
