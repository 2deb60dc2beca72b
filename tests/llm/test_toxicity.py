"""Toxicity: label model on simulated voters, held-out accuracy, odd rows."""

import numpy as np

from bazaar.llm import toxicity

SF = "/root/testdata/sf0.01"


def test_label_model_finds_rates_and_discounts_copies():
    rng = np.random.default_rng(3)
    y = rng.random(6000) < 0.3
    rates = [(0.7, 0.05), (0.5, 0.02), (0.6, 0.1), (0.4, 0.01)]
    v = np.column_stack([rng.random(6000) < np.where(y, a, b) for a, b in rates])
    v = np.column_stack((v, v[:, 0], v[:, 0]))  # one voter thrice
    start = np.where(rng.random(6000) < 0.15, ~y, y) * 0.8 + 0.1
    model = toxicity.label_model(v, start)
    assert np.allclose(model.on_toxic[:4], [a for a, _ in rates], atol=0.1)
    assert model.weight[0] < 0.45 and model.weight[1] > 0.9
    assert ((model.posterior(v.astype(float)) >= 0.5) == y).mean() > 0.9


def test_features():
    assert len(toxicity.features(None)) == len(toxicity.features(" 12")) == 0
    assert set(toxicity.features("IDIOT.")) == set(toxicity.features("idiot")) and len(toxicity.features("idiot")) == 3


def test_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(-1, None), (-2, ""), (None, "clean words"), (-3, "an idiot , a moron , scum"), (-3, "an idiot , a moron , scum")], "doc_id long, text string")
    rows = toxicity.judged(docs.select("doc_id", "text").unionByName(odd), labels).toPandas()
    assert len(rows) == docs.count() + 5 and rows["score"].between(0, 1).all()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = rows[rows["held_out"] & rows["doc_id"].isin(list(truth))]
    real = held["doc_id"].map(truth).to_numpy()
    hit = held["predicted"].to_numpy()
    assert (hit == real).mean() > 0.93 and hit[real == 1].mean() >= 0.5
    by = rows.set_index("doc_id")
    assert by.loc[-1, "predicted"] == by.loc[-2, "predicted"] == 0 and (by.loc[-3, "predicted"] == 1).all()
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == (rows["predicted"][: -5] == 0).sum()


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "an idiot", 5)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.judged(docs, labels).collect()[0]["score"] == 0
    assert toxicity.without_toxic(docs, labels).count() == 1
    assert toxicity.judged(docs.limit(0), labels.limit(0)).count() == 0
