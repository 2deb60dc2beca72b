"""Secret scans: planted tokens on held-out documents, false positives, odd rows."""

import hashlib
import re

import pytest

from bazaar.llm import secret_scan

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    hexes = [hashlib.sha256(str(i).encode()).hexdigest()[:40] for i in range(60)]
    made = [(-i - 1, f'some words here api_key = "{h}" and more', "repo/src/a.py") for i, h in enumerate(hexes[:40])]
    made += [(-100 - i, f"commit {h} by someone who wrote a verylongwordwithoutmeaning", "repo/tests/b") for i, h in enumerate(hexes[40:])]
    made += [(-200, None, "x"), (-201, "", None), (None, f'token = "{hexes[0]}"', None), (-202, f'token: "{hexes[1]}" token: "{hexes[1]}"', "é"), (-202, "1234567890123456789", "é")]
    return real.unionByName(spark.createDataFrame(made, "doc_id long, text string, source string"))


def test_scan(docs):
    rows = secret_scan.scan(docs).toPandas()
    text = {r["doc_id"]: r["text"] for r in docs.filter("doc_id is not null and doc_id <> -202").collect()}
    for r in rows[rows["doc_id"].isin(list(text))].head(400).itertuples():
        assert text[r.doc_id][r.start - 1 :].startswith(r.candidate) and text[r.doc_id].find(r.candidate) == r.start - 1
    planted = {(d, x) for d, t in text.items() for x in re.findall(r'(?:token|api_key) = "([0-9a-f]{40})"', t or "")}
    by = {(r.doc_id, r.candidate): r for r in rows.itertuples()}
    assert len(planted) > 45 and all(by[k].is_secret for k in planted)
    words = [r for r in rows.itertuples() if r.candidate.isalpha() or r.candidate.isdigit()]
    assert len(words) > 50 and not any(r.is_secret for r in words)
    assert not any(r.is_secret for r in rows.itertuples() if -120 < r.doc_id <= -100)
    twice = rows[(rows["doc_id"] == -202) & (rows["candidate"].str.len() == 40)]
    assert len(twice) == 1 and twice.iloc[0]["occurrences"] == 2
    assert not rows["doc_id"].isin([-200, -201]).any()
    assert rows["score"].between(0, 1).all()


def test_given_labels_and_none(spark, docs):
    few = docs.filter("doc_id < 0 and doc_id > -100")
    assert not secret_scan.scan(few.filter("doc_id > -3")).filter("NOT is_secret").count()  # one class: the seed rule
    assert secret_scan.scan(docs.limit(0)).count() == 0
    labels = secret_scan.scan(docs.filter("doc_id < 0")).selectExpr("doc_id", "candidate", "cast(doc_id > -100 as int) label")
    found = secret_scan.secrets(docs.filter("doc_id < 0"), labels)
    assert {"doc_id", "start", "length", "fingerprint"} <= set(found.columns) and found.filter("doc_id > -100").count() == 40
