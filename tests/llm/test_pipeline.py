"""The pipeline's stages against plain versions on a small corpus, and the registered queries against their SQL."""

import random

import pytest
from compare import compare, database

import corpus_pipeline
from bazaar.llm import queries, statements
from bazaar.llm.common import saved

SF = "/root/testdata/sf0.001"


def near_copies(rows):
    """Kept ids: the smallest of each group linked by Jaccard >= 0.8 over five-word shingles."""

    def shingles(t):
        w = t.encode().lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if inter and 100 * inter >= 80 * (len(sets[i]) + len(sets[j]) - inter):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return {d for i, (d, _) in enumerate(rows) if least[find(i)] == d}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen, texts = docs.columns, [], {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        texts[name] = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        docs = saved(stage(spark, docs, SF), "stage")
        assert docs.columns == columns, name
        seen.append(docs.count())
    kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
    deduped = texts["mixing sources to target weights"]
    assert set(deduped) == near_copies(sorted(texts["n-gram Jaccard join"].items()))
    lines = texts["n-gram Jaccard join"]
    before = texts["line dedup"]
    assert set(lines) <= set(before) and all(set(t.split("\n")) <= set(before[d].split("\n")) for d, t in lines.items())
    assert kept <= set(deduped)
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, SF).toPandas()
    assert set(pieces["doc_id"]) == kept and pieces.groupby("sequence_id")["length"].sum().max() <= 2048
    per = docs.groupBy("doc_id").count().collect()
    first = pieces[pieces["piece"] == 0].groupby("doc_id").size().to_dict()
    assert first == {r["doc_id"]: r["count"] for r in per}


def test_planted_copies_and_clean_documents(spark):
    """Exact and near copies go but for one; other documents stay, with all their text."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    clean = [" ".join(rng.choices(words, k=120)) + "\n" + " ".join(rng.choices(words, k=90)) for _ in range(30)]
    near = []
    for t in clean[:10]:
        w = t.split(" ")
        w[rng.randrange(len(w))] = "changed"
        near.append(" ".join(w))
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(clean + clean[:5] + near)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    for _, stage in corpus_pipeline.STAGES[1:3]:
        docs = saved(stage(spark, docs, SF), "stage")
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == dict(enumerate(clean))


def test_odd_rows_and_columns(spark, tmp_path):
    """Null ids and texts, ids that repeat, columns that operators use for themselves, and no rows at all."""
    rng = random.Random(8)
    text = [" ".join(rng.choices([f"w{i}" for i in range(3000)], k=80)) for _ in range(8)]
    rows = [(1, text[0]), (1, text[1]), (2, text[2]), (2, text[2]), (3, text[2] + " more"), (None, text[3]), (None, text[3]), (4, None), (5, ""), (6, " \n"), (7, "x" * 200_000 + " " + text[4])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _kept int, th int, row string, node long, copies int, `a.b` int"
    docs = spark.createDataFrame([(d, t, "en", None if d == 2 else "s", len(t or ""), 1, 2, "r", 3, 4, 5) for d, t in rows], schema).repartition(3)
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[1:4]:
        docs = saved(stage(spark, docs, SF), "stage")
        assert docs.columns == columns
        assert docs.filter("th <> 2 OR `a.b` <> 5 OR row <> 'r'").count() == 0
        left = sorted({(r["doc_id"], r["text"]) for r in docs.collect()}, key=str)
        want = [(1, text[0]), (1, text[1]), (2, text[2]), (None, text[3]), (7, "x" * 200_000 + " " + text[4])]
        assert {x for x in left if x[1] and x[1].strip()} <= set(want), stage
    assert {r["doc_id"] for r in docs.collect()} <= {1, 2, 7, None}
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, none, SF).count() == 0
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_names():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    assert sorted(int(q[2:].split("_")[0]) for q in queries.queries()) == list(range(1, 14))


@pytest.mark.parametrize("key", list(statements.statements()))
def test_query_equals_sql(spark, key):
    assert compare(spark, database(SF), key, queries.queries()[key], statements.statements()[key], SF) == ""
