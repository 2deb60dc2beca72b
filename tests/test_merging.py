"""Snapshots in any order, as-of joins with hot cells, differences of versions: against plain forms."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bazaar.operators import asof, diff
from bazaar.operators.scd2 import merge_snapshot, merged_series, scd2

DAYS = ["2026-06-01", "2026-06-05", "2026-06-09", "2026-06-10"]
FIRST = "2020-01-01"


def snapshots(seed):
    rng = random.Random(seed)
    return {d: [(f"K{k}", rng.choice(["a", "b", None]), rng.choice([1, 2])) for k in range(40) if rng.random() < 0.7] for d in DAYS}


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, name string, n int")


def whole(spark, held):
    rows = [(*r, d) for d, found in held.items() for r in found]
    if not rows:
        return set()
    table = spark.createDataFrame(rows, "id string, name string, n int, day string").withColumn("day", F.col("day").cast("date"))
    return set(map(tuple, scd2(table, "id", ["name", "n"], "day", FIRST).collect()))


@pytest.mark.parametrize("seed, order", [(1, (0, 1, 2, 3)), (2, (3, 2, 1, 0)), (3, (1, 3, 0, 2)), (4, (2, 0, 3, 1))])
def test_snapshots_in_any_order(spark, seed, order):
    series, held, found = snapshots(seed), {}, []
    versions = spark.createDataFrame([], "id string, name string, n int, valid_from date, valid_to date, is_current boolean")
    steps = [(DAYS[i], series[DAYS[i]]) for i in order]
    steps += [(DAYS[order[1]], snapshots(seed + 9)[DAYS[0]]), (DAYS[0], None), (DAYS[3], None)]  # one again, two removed
    for day, rows in steps:
        known = sorted(held)
        changed, fresh = merge_snapshot(versions, known, frame(spark, rows or []), day, "id", ["name", "n"], "day", FIRST, rows is not None)
        stays = versions.join(changed, "id", "left_anti").collect()
        untouched = {tuple(r) for r in stays}
        found = [tuple(r) for r in stays] + [tuple(r) for r in fresh.collect()]
        versions = spark.createDataFrame(found, versions.schema)
        held = held | {day: rows} if rows is not None else {d: r for d, r in held.items() if d != day}
        assert merged_series(known, day, rows is not None) == sorted(held)
        assert Counter(found) == Counter(whole(spark, held)), (day, known)
        assert untouched <= whole(spark, held)


def test_only_changed_keys_are_built(spark):
    series = snapshots(5)
    table = spark.createDataFrame([(*r, d) for d in DAYS[:2] for r in series[d]], "id string, name string, n int, day string").withColumn("day", F.col("day").cast("date"))
    versions = scd2(table, "id", ["name", "n"], "day", FIRST)
    same = [(i, "new" if i == "K3" else a, n) for i, a, n in series[DAYS[1]]]
    changed, fresh = merge_snapshot(versions, DAYS[:2], frame(spark, same), DAYS[2], "id", ["name", "n"], "day", FIRST)
    want = {"K3"} & {r[0] for r in same}
    assert {r.id for r in changed.collect()} == want == {r.id for r in fresh.collect()}


def hot(spark, n=6000):
    rng = random.Random(7)
    rows = [(i, "A", f"2026-03-{rng.randrange(1, 32):02} {rng.randrange(24):02}:{rng.randrange(60):02}:{rng.randrange(60):02}.{rng.randrange(10**6):06}") for i in range(n * 9 // 10)]
    rows += [(i, rng.choice(["A", "B", None]), f"2026-0{rng.randrange(1, 8)}-11 10:00:00") for i in range(n * 9 // 10, n - 1)] + [(n - 1, "B", None)]
    rates = [(k, f"2026-0{m}-{d:02} 0{h}:30:00", m * 100 + d + h / 10) for k in "AB" for m in (2, 3, 5) for d in range(1, 28) for h in (1, 7)]
    left = spark.createDataFrame(rows, "id int, k string, at string").withColumn("at", F.col("at").cast("timestamp"))
    right = spark.createDataFrame(rates, "k string, since string, v double").withColumn("since", F.col("since").cast("timestamp"))
    return left.repartition(6), right


def test_hot_cells_are_cut_evenly(spark):
    left, right = hot(spark)
    probes = left.filter("k is not null and at is not null").select("k", "at").distinct()
    bounds = asof.time_ranges(probes, ["k"], "at", per_range=100)
    sizes = [r["n"] for r in asof.in_ranges(probes, bounds, ["k"], "at").filter("month(_bucket) = 3 and k = 'A'").groupBy("_range").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 40 and max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]


@pytest.mark.parametrize("per_range", [1, 100, 10**6])
def test_hot_asof(spark, per_range):
    left, right = hot(spark, 2000)
    got = {r.id: r.v for r in asof.asof_join_hot(left, right, ["k"], "at", "since", ["v"], per_range=per_range).collect()}
    rates = sorted((r.k, r.since, r.v) for r in right.collect())
    for r in left.collect():
        known = [v for k, since, v in rates if k == r.k and r.at is not None and since <= r.at]
        assert got[r.id] == (known[-1] if known else None)
    assert len(got) == left.count()


def test_version_diff(spark):
    schema = "id string, payload string"
    old = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1"), (None, "x"), ("c", None), ("d", "1"), ("e", "1")], schema)
    new = spark.createDataFrame([("a", "1"), ("b", "2"), (None, "x"), ("c", ""), ("d", "1"), ("f", "1")], schema)
    found = diff.version_diff(old, new, ["id"], diff.digest("payload"))
    assert sorted((r.id, r.change) for r in found.collect()) == [("a", "recounted"), ("b", "added"), ("b", "removed"), ("c", "added"), ("c", "removed"), ("e", "removed"), ("f", "added")]
    kinds = {r.id: r.change for r in diff.changed_keys(found, ["id"]).collect()}
    assert kinds == {"a": "changed", "b": "changed", "c": "changed", "e": "removed", "f": "added"}
    assert diff.version_diff(old, old, ["id"], diff.digest("payload")).count() == 0
    assert list(itertools.islice(diff.version_diff(old.limit(0), old.limit(0), ["id"], diff.digest("payload")).collect(), 1)) == []
