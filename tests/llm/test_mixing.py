"""Mixing: targets against resharing step by step, totals near targets, fair draws, edge rows."""

import numpy as np
import pytest

from bazaar.llm import mixing


def stepwise(sizes):
    """Shares as the contract words them: reshare the excess until no source is above three times its size."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not above:
            return share | {s: 3.0 * sizes[s] for s in full}
        full |= set(above)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 40}, {"x": 7}, {"é": 1, "z": 1, "Z": 900, "b": 3, "k": 0}])
def test_targets(spark, sizes):
    rows = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    want = stepwise(sizes)
    assert {r["source"]: r["target"] for r in rows} == pytest.approx(want)


def test_rounding_is_fair_and_keeps_the_total():
    rng = np.random.default_rng(0)
    a = rng.integers(1, 50, 40).astype(float)
    sums, n = np.zeros(40), 3000
    for _ in range(n):
        out, rest = mixing.settled(a, np.full(40, 0.3), rng.random(40))
        assert (a * out).sum() == pytest.approx(0.3 * a.sum())
        assert all(x in (0, 1) for i, x in enumerate(out) if i != rest)
        sums += out
    assert abs(sums / n - 0.3).max() < 0.05


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 50)
    monkeypatch.setattr(mixing, "FAN", 4)
    rows = [(i, "w " * (1 + i * 7 % 90), f"s{0 if i % 3 else i % 5}", 1) for i in range(3000)]
    rows += [(-1, None, "s0", 1), (-2, " \n", None, 1), (None, "x y", None, 2), (None, "x y", None, 2), (5, "w " * 36, "s0", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int")
    got = mixing.taken(docs).toPandas()
    assert len(got) == len(rows) and (got["taken"] <= 3 * got["size"]).all()
    for _, one in got.groupby("source", dropna=False):
        assert abs(one["taken"].sum() - one["target"].iloc[0]) < one["size"].max() + 1e-6
        assert one["source_size"].iloc[0] == one["size"].sum()
    again = mixing.taken(docs.repartition(7)).toPandas()
    cols = ["doc_id", "size", "taken"]
    assert sorted(map(str, got[cols].values.tolist())) == sorted(map(str, again[cols].values.tolist()))
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    assert mix.count() == (got["taken"] // got["size"].clip(lower=1)).sum()
    assert mixing.taken(docs.limit(0)).count() == 0


def test_many_equal_rows_end_near_the_target(spark, monkeypatch):
    """Rows of one id and size are settled row by row: some get a copy more than others."""
    monkeypatch.setattr(mixing, "_BINS", 8)
    rows = [(None, f"t{i % 50} b c d e", "s1") for i in range(600)] + [(i, "w " * (i % 7 + 1), "s2") for i in range(300)] + [(7, "same same", "s3")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.taken(docs).toPandas()
    assert len(got) == len(rows) and got.groupby("source")["copies"].nunique().max() >= 2
    for _, one in got.groupby("source"):
        assert abs(one["taken"].sum() - one["target"].iloc[0]) < one["size"].max()
        assert one["copies"].max() - one["copies"].min() <= 1 and one["copies"].max() <= 3
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns and mix.count() == got["copies"].sum()
