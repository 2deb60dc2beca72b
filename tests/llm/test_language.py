"""Language profiles: cases without letters, reruns, and held-out accuracy."""

from bazaar.llm import language

SF = "/root/testdata/sf0.001"


def test_grams():
    assert len(language.grams(None)) == len(language.grams("12 .-")) == 0
    assert (language.grams("Ab,ab") == language.grams("ab  AB")).all()
    assert len(language.grams("a")) == 1


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, None, "xx"), (-2, "  12 ", "xx"), (None, "the and of", None), (-3, "", None)], docs.schema)
    rows = language.identified(docs.unionByName(odd)).collect()
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 20 and sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    by = {r["doc_id"]: r for r in rows}
    assert [by[k]["lang_pred"] for k in (-1, -2, -3)] == ["und"] * 3 and by[-1]["score"] == 0
    assert by[None]["lang_pred"] in set(truth.values()) and all(0 <= r["score"] <= 1 for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, language.identified(docs.unionByName(odd)).collect()))


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert language.identified(docs).collect()[0]["lang_pred"] == "und"
