import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bazaar.operators import dedup, joins, quality, rules, upsert
from bazaar.operators.quantiles import exact_percentiles
from bazaar.operators.scd2 import scd2


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_mark_latest_keeps_all_rows_and_flags_one_per_key(spark):
    rows = [("a", 1, "r1"), ("a", 3, "r2"), ("a", 3, "r3"), ("b", 1, "r4"), (None, 1, "r5"), (None, 2, "r6"), ("c", None, "r7"), ("c", 9, "r8")]
    df = spark.createDataFrame(rows, "k string, t int, id string")
    flags = {r.id: r.top for r in dedup.mark_latest(df, ["k"], ["t"], "id", "top").collect()}
    assert len(flags) == 8
    # Ties go to the larger id; null times come first in descending order.
    assert {k for k, v in flags.items() if v} == {"r3", "r4", "r6", "r7"}


def test_latest_by_equals_marking(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(20), rng.randrange(10), f"{n:04}") for n in range(500)]
    df = spark.createDataFrame(rows, "k int, t int, id string")
    marked = dedup.mark_latest(df, ["k"], ["t"], "id", "top").filter("top").drop("top")
    assert sorted(dedup.latest_by(df, ["k"], ["t"], ["id"]).collect()) == sorted(marked.collect())


def test_hot_key_is_split_by_the_adaptive_plan(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold="0",
        spark__sql__shuffle__partitions="16",
    )
    fact = spark.range(200_000, numPartitions=8).select(
        "id", F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 100).alias("k"), F.md5(F.col("id").cast("string")).alias("pad")
    )
    side = spark.range(50).select(F.col("id").alias("k"))  # grouped by the join key below
    joined = joins.flag_known(fact, "k", side, "k", "known")
    assert joined.groupBy("known").count().count() == 2
    result = joined.select("id", "known").collect()
    plan = joined._jdf.queryExecution()
    executed = joined.select("id", "known")
    executed.collect()
    assert "skew=true" in executed._jdf.queryExecution().executedPlan().toString(), plan
    assert len(result) == 200_000
    assert sum(r.known for r in result) == 100_000 + sum(1 for n in range(1, 200_000, 2) if n % 100 < 50)


def test_flag_known_treats_null_as_unknown(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    ref = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    assert {r.k: r.f for r in joins.flag_known(df, "k", ref, "id", "f").collect()} == {"a": True, "z": False, None: False}


def brute_asof(left, right):
    found = []
    for lid, key, at in left:
        before = [(since, v) for k, since, v in right if k == key and at is not None and since <= at]
        found.append((lid, max(before)[1] if before else None))
    return sorted(found)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("join", [joins.asof_join_daily, joins.asof_join_large])
def test_asof_equals_brute_force(spark, join, seed):
    rng = random.Random(seed)
    left = [(n, rng.choice(["a", "b", "c", None]), rng.choice([day(rng.randrange(200)), None])) for n in range(300)]
    right = sorted({(k, day(rng.randrange(30, 160))) for k in "abd" for _ in range(12)})
    right = [(k, d, n) for n, (k, d) in enumerate(right)]
    l = spark.createDataFrame(left, "id int, k string, at date")
    r = spark.createDataFrame(right, "k string, since date, v int")
    out = join(l, r, ["k"], "at", "since", ["v"])
    assert out.columns == ["id", "k", "at", "v"]
    assert sorted((x.id, x.v) for x in out.collect()) == brute_asof(left, right)


def test_interval_join_bounds(spark):
    versions = spark.createDataFrame([("a", day(0), day(10), 1), ("a", day(10), None, 2)], "k string, f date, t date, v int")
    facts = spark.createDataFrame([("a", day(-1)), ("a", day(0)), ("a", day(9)), ("a", day(10)), ("b", day(5))], "k string, d date")
    out = joins.interval_join(facts, versions, ["k"], "d", "f", "t")
    assert sorted([(r.k, r.d, r.v) for r in out.collect()], key=str) == [
        ("a", day(-1), None), ("a", day(0), 1), ("a", day(9), 1), ("a", day(10), 2), ("b", day(5), None),
    ]


def versions(spark, rows, **options):
    df = spark.createDataFrame(rows, "k string, v string, snap date")
    out = scd2(df, "k", ["v"], "snap", "2020-01-01", **options)
    return sorted([(r.k, r.v, r.valid_from, r.valid_to, r.is_current) for r in out.collect()], key=str)


FIRST = dt.date(2020, 1, 1)


def test_scd2_two_snapshots(spark):
    rows = [
        ("same", "x", day(1)), ("same", "x", day(2)), ("changed", "x", day(1)), ("changed", None, day(2)),
        ("gone", "x", day(1)), ("new", "x", day(2)),
    ]
    expected = sorted(
        [
            ("same", "x", FIRST, None, True), ("changed", "x", FIRST, day(2), False), ("changed", None, day(2), None, True),
            ("gone", "x", FIRST, day(2), False), ("new", "x", day(2), None, True),
        ], key=str,
    )
    assert versions(spark, rows) == expected
    assert versions(spark, rows, only_bounds=True) == expected


def test_scd2_one_snapshot(spark):
    assert versions(spark, [("a", "x", day(1))]) == [("a", "x", FIRST, None, True)]
    assert versions(spark, [("a", "x", day(1))], only_bounds=True) == [("a", "x", FIRST, None, True)]


def test_scd2_skipped_snapshot_makes_two_versions(spark):
    rows = [("back", "x", day(1)), ("back", "x", day(3)), ("other", "x", day(2)), ("other", "y", day(3))]
    assert versions(spark, rows) == [
        ("back", "x", FIRST, day(2), False), ("back", "x", day(3), None, True),
        ("other", "x", day(2), day(3), False), ("other", "y", day(3), None, True),
    ]
    assert versions(spark, rows, only_bounds=True) == [("back", "x", FIRST, None, True), ("other", "y", day(3), None, True)]


@pytest.mark.parametrize("seed", [3, 4])
def test_percentiles_equal_numpy(spark, seed):
    rng = random.Random(seed)
    rows = [(g, rng.choice([5, -7, rng.randrange(-10**9, 10**9), rng.randrange(1000)])) for g in "abc" for _ in range(rng.randrange(1, 400))]
    rows.append(("one", 42))
    df = spark.createDataFrame(rows + [("a", None)], "g string, v long")
    out = exact_percentiles(df, "g", "v", {"p50": 0.5, "p90": 0.9}, 10**8)
    found = {r.g: (r.p50, r.p90, r.row_count) for r in out.collect()}
    for g in ("a", "b", "c", "one"):
        mine = [v for k, v in rows if k == g]
        assert found[g][2] == len(mine)
        assert found[g][:2] == pytest.approx(tuple(np.percentile(mine, [50, 90])))


def test_first_match_ignores_null_predicates(spark):
    df = spark.createDataFrame([(None,), ("b",), ("a",)], "c string")
    code = rules.first_match([("not_a", ~F.col("c").isin("a")), ("missing", F.col("c").isNull())])
    assert {r.c: r.code for r in df.select("c", code.alias("code")).collect()} == {None: "missing", "b": "not_a", "a": None}


def test_upsert_keeps_repeats_of_the_batch(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], "k int, v string")
    batch = spark.createDataFrame([(2, "new"), (2, "again"), (3, "new")], "k int, v string")
    out = upsert.upsert(target, batch, ["k"])
    assert sorted([(r.k, r.v) for r in out.collect()], key=str) == [(1, "old"), (2, "again"), (2, "new"), (3, "new"), (None, "old")]


def test_replace_range_empties_a_range_without_rows(spark):
    target = spark.createDataFrame([(1,), (5,), (9,), (None,)], "t int")
    empty = target.limit(0)
    left = upsert.replace_range(target, empty, F.col("t"), 5, 9)
    assert sorted([r.t for r in left.collect()], key=str) == [1, 9, None]


def test_high_watermark_of_an_empty_target(spark):
    events = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t timestamp")
    later = events.filter(F.col("t") > upsert.high_watermark(events.limit(0), F.col("t")))
    assert later.count() == 1
    assert events.filter(F.col("t") > upsert.high_watermark(events, F.col("t"))).count() == 0


def test_quality_checks_and_gate(spark):
    rows = spark.createDataFrame([("a", 1), ("a", None), ("z", 2), (None, 3)], "k string, n int")
    parents = spark.createDataFrame([("a",), ("b",)], "id string")
    results = quality.all_results(
        [
            quality.run_row_checks("t", rows, [quality.not_null("n"), quality.accepted_values("k", ["a"]), quality.not_empty()]),
            quality.run_row_checks("empty", rows.limit(0), [quality.not_empty()]),
            quality.unique("t", rows, ["k"]),
            quality.relationship("t", rows, "k", parents, "id"),
            quality.same_count("t", "grain", rows, parents),
        ]
    )
    found = {(r.table_name, r.check_name): r.failures for r in results.collect()}
    assert found == {
        ("t", "not_null_n"): 1, ("t", "accepted_values_k"): 1, ("t", "row_count"): 0, ("empty", "row_count"): 1,
        ("t", "unique_k"): 1, ("t", "relationship_k"): 1, ("t", "grain"): 1,
    }
    with pytest.raises(quality.ChecksFailed, match="not_null_n=1"):
        quality.gate(results)
    quality.gate(results.filter("passed"))


def test_freshness(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t timestamp")

    def stale(now):
        check = quality.fresh("t", F.lit(now).cast("timestamp"))
        return quality.run_row_checks("t", rows, [check]).first().failures

    assert stale("2024-01-07 23:59:59") == 0
    assert stale("2024-01-08 00:00:00") == 1
