"""Quality measures against a plain version; ledger, policies and ablations."""

import re

from hypothesis import given
from hypothesis import strategies as st

from bazaar.llm import quality

TEXTS = [None, "", "   \n\t", "one", "a b c d e f g h " * 5, "x | y\nx | y\n\nz\r\n", "ÄÖ ü!! é　ß", "word\x0bword\x1fword"]


def plain(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, repeat = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            repeat |= {j for i in at for j in range(i, i + 8)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeat),
    )


def test_edge_texts():
    for t in TEXTS:
        assert quality.measured(t)[:5] == plain(t), repr(t)


@given(st.text(alphabet=st.sampled_from("ab \n\t\x0b|é #\x1e漢"), max_size=300))
def test_measures(text):
    assert quality.measured(text)[:5] == plain(text)


def test_ledger_and_policies(spark):
    clean = " ".join(f"word{i}" for i in range(40))
    rows = [(1, clean, "x"), (2, None, "x"), (3, "a b c d e f g h " * 6, None), (4, clean.replace(" ", "| "), "y"), (1, clean, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, failures string")
    ledger = quality.ledger(docs)
    got = {r["doc_id"]: r for r in ledger.collect()}
    assert got[1]["failures"] == 0 and got[2]["failures"] & 1 and got[3]["failures"] & 2 and got[4]["failures"] & 8
    assert sorted(r["doc_id"] for r in quality.kept(ledger, "base").collect()) == [1, 1, 4]
    assert sorted(r["doc_id"] for r in quality.kept(ledger, "v2").collect()) == [1, 1]
    cost = {r["rule"]: r for r in quality.ablations(ledger, "v2").collect()}
    assert cost["few_words"]["fails"] == 1 and cost["symbols"]["fails_alone"] == 1 and cost["symbols"]["kept_without"] == 3
    assert quality.digest(docs.limit(0)).count() == 0
