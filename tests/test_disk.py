"""What queries on the lake leave on disk while they run."""

import time

import builders as b
import pytest

from bazaar import queries, session
from bazaar.operators.diff import changed_keys, digest, version_diff
from bazaar.plans import places

DOCS = [
    b.order("a1"), b.order("a1", updated_at="2026-06-01T10:00:00Z"), b.order("a2", {"product_id": "P9"}),
    b.order("a3", customer_id="C9", updated_at="2024-06-01T09:00:00Z"), b.order("a3", updated_at="2026-06-02T09:00:00Z"),
]


@pytest.fixture
def layers(spark, tmp_path, monkeypatch):
    """Inputs whose bronze rows are given, with a work folder of their own."""
    monkeypatch.setattr(session, "_home", lambda spark: f"{tmp_path}/shared")
    (tmp_path / "in").mkdir()
    found = queries.Inputs(spark, f"{tmp_path}/in")
    found.__dict__ |= {"bronze_orders": b.orders(spark, DOCS), "bronze_customers": b.customers(spark, b.CUSTOMERS), "bronze_products": b.products(spark, b.PRODUCTS)}
    yield found
    session.settle(spark)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_shuffle_files_go_with_their_execution(spark, layers, tmp_path):
    before = shuffle_files(spark)
    kept = spark.range(1000).repartition(3)  # as a plan that somebody holds: no collection of garbage frees it
    kept.write.parquet(f"{tmp_path}/out")
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_shared_tables_are_packed(layers, tmp_path):
    assert layers.share_staged_lines().staged_lines.count() == 5
    names = [p.name for p in tmp_path.glob("shared/staged_lines-*/part-*")]
    assert names and all(n.endswith(".zstd.parquet") for n in names)


@pytest.mark.parametrize("name", ["incremental_by_order", "incremental_rejected"])
def test_staging_is_done_once(layers, name):
    rows = queries.REGISTRY[name](layers)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan  # documents are opened by the two tables that the plan reads
    assert rows.count() == {"incremental_by_order": 2, "incremental_rejected": 4}[name]


def test_pages_are_packed(layers, tmp_path):
    found = queries.REGISTRY["src_order_pages"](layers).collect()
    files = [p.name for p in tmp_path.glob("shared/pages-*/part-*")]
    assert files and all(n.endswith(".gz") for n in files)
    assert sorted((r["order_id"] or "", r["kind"]) for r in found) == [("", "unreadable_page"), *[(o, "record") for o in ("a1", "a1", "a2", "a3", "a3")]]


def test_index_notes_emptied_places_only(spark):
    now = spark.createDataFrame([("o1", "t", "2026-06"), ("o1", "t", "2026-05"), ("o1", "t", "2026-06"), ("o2", "t", "2026-06")], "_entity string, tab string, part string")
    before = spark.createDataFrame([("o2", "t", ["2026-01"]), ("o3", "t", ["2026-01"]), ("o4", "t", []), ("o5", "elsewhere", ["2026-01"])], places.SCHEMA)
    got = {(r["_entity"], r["tab"]): r["parts"] for r in places.replaced(now, before, ["t"]).collect()}
    assert got == {("o1", "t"): ["2026-05", "2026-06"], ("o2", "t"): ["2026-06"], ("o3", "t"): []}


def test_changes_are_counted_by_hash(spark):
    old = spark.createDataFrame([("gone", "x"), ("same", "x"), ("other", None), ("twice", "x")], "k string, payload string")
    new = spark.createDataFrame([("new", "x"), ("same", "x"), ("other", ""), ("twice", "x"), ("twice", "x")], "k string, payload string")
    diff = version_diff(old, new, ["k"], digest("payload")).select("k", "change")
    kinds = changed_keys(diff, ["k"])
    assert {r["k"]: r["change"] for r in kinds.collect()} == {"gone": "removed", "new": "added", "other": "changed", "twice": "changed"}
    assert "ObjectHashAggregate" not in kinds._jdf.queryExecution().executedPlan().toString()
