"""Line dedup against all pairs, and the stream that finds shared tokens at any batch size."""

import random

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from bazaar.llm import bitmap, common, lines, mixing, queries


def line_set(line):
    w = line.encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def all_pairs(rows):
    """Removed (doc, line) by comparing every line with every earlier one; ids do not repeat with other texts here."""
    every = sorted({(d, i): x for d, t in rows if d is not None for i, x in enumerate((t or "").split("\n"))}.items())
    sets, gone = [(k, line_set(x)) for k, x in every], set()
    for j, (key, b) in enumerate(sets):
        for _, a in sets[:j]:
            inter = len(a & b)
            if inter and 100 * inter >= 80 * (len(a) + len(b) - inter):
                gone.add(key)
                break
    return gone


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    stock = [" ".join(rng.choices(words, k=rng.choice([3, 5, 8, 20, 40, 60]))) for _ in range(25)]
    rows = []
    for d in range(70):
        parts = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(stock).split(" ")
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                line[rng.choice([0, -1, rng.randrange(len(line))])] = rng.choice(words)
            parts.append(" ".join(line))
        rows.append((d * 7 % 71, "\n".join(parts)))
    return rows + [(500, None), (501, ""), (502, "\n\n"), (None, stock[3]), (rows[5][0], rows[5][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(d, t, 0, "x") for d, t in rows], "doc_id long, text string, n_chars int, line string").repartition(3)
    want = all_pairs(rows)
    assert {(r["doc"], r["line"]) for r in lines.removed(docs).collect()} == want
    text = lambda d, t: t if t is None or d is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in want)
    got = lines.deduplicated(docs, keep_empty=True)
    assert got.columns == docs.columns
    assert sorted([(r["doc_id"], r["text"]) for r in got.collect()], key=str) == sorted([(d, text(d, t)) for d, t in rows], key=str)
    left = lines.deduplicated(docs).collect()
    lost = [1 for d, t in rows if t and t.split() and text(d, t) is not None and not text(d, t).split()]
    assert len(left) == len(rows) - len(lost)
    assert lines.deduplicated(docs.limit(0)).count() == 0


def test_stream_in_any_batches():
    rng = np.random.default_rng(5)
    rows = pd.DataFrame({"token": rng.integers(0, 40, 300), "kind": rng.integers(0, 4, 300), "doc": rng.integers(0, 30, 300), "at": 0, "pos": 0})
    rows = rows.sort_values(["token", "kind", "doc", "at"], ignore_index=True)

    def found(size):
        out = pd.concat(list(lines._met(rows.iloc[i : i + size] for i in range(0, len(rows), size))))
        return sorted(map(tuple, out.to_numpy().tolist()))

    want = found(300)
    assert all(found(s) == want for s in (1, 2, 7, 50))


def test_bitmap(spark):
    may = bitmap.may_hold(spark.createDataFrame([(i * 3,) for i in range(200)] + [(None,)], "k long"), "k", bits=16)
    rows = spark.range(600).selectExpr("id", "if(id = 5, null, id) k")
    found = {r["id"] for r in rows.filter(may(rows["k"])).collect()}
    assert found >= set(range(0, 600, 3)) and len(found) < 230 and 5 not in found


def test_large_ids_beside_a_null(spark, tmp_path):
    """Ids above 2 to the 53 stay what they are in batches that hold a null id, and are found in bitmaps."""
    big = (1 << 60) + 1
    text = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(4)]
    rows = [(big, text[0]), (None, text[1]), (big + 2, text[0] + "\n" + text[2]), (big + 4, text[3]), (None, None), (big + 6, text[3])]
    docs = spark.createDataFrame([(d, t, "s", "en") for d, t in rows], "doc_id long, text string, source string, lang string").coalesce(1)
    may = bitmap.may_hold(docs.filter(f"doc_id <> {big + 4}"), "doc_id")
    found = [r["doc_id"] for r in docs.filter(may(docs["doc_id"])).collect()]
    assert {big, big + 2, big + 6} <= set(found) and None not in found
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(big, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    ids = sorted((d for d, _ in rows), key=str)
    for name in ("op2_language_id", "op3_best_fit_packing", "op4_ngram_jaccard", "op6_quality_rules", "op9_line_dedup", "op10_toxicity"):
        got = queries.queries()[name](spark, str(tmp_path)).collect()
        assert sorted((r["doc_id"] for r in got), key=str) == ids, name
        if name == "op4_ngram_jaccard":
            links = {r["doc_id"]: r["component_id"] for r in got}
            assert links[big + 6] == big + 4 and links[big] == big and links[None] is None
        if name == "op9_line_dedup":
            left = {r["doc_id"]: r["text"] for r in got if r["doc_id"]}
            assert left == {big: text[0], big + 2: text[2], big + 4: text[3], big + 6: ""}
    sizes = docs.selectExpr("doc_id", "source", "cast(30 as long) n_words")
    shares = spark.createDataFrame([("s", 6, 180, 180.0)], "source string, n_docs long, source_size long, target double")
    assert {r["doc_id"] for r in mixing.copies(sizes, shares).collect()} == set(ids)


def test_short_lines_in_query_and_pipeline(spark, tmp_path):
    """Repeats of lines of one to four words go too, and nothing else of that length."""
    long = " ".join(f"w{i}" for i in range(12))
    texts = ["Read more\n" + long, "read  MORE\nread more now", "more read\n\none", "one\na b c d\n" + long, "a b c d e\na b c d\nRead more", None, "one"]
    want = ["Read more\n" + long, "read more now", "more read\n\none", "a b c d", "a b c d e", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["text"] for r in queries.queries()["op9_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == dict(enumerate(want))
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.drop_lines(spark, docs, str(tmp_path)).collect()}
    assert left == {i: t for i, t in enumerate(want) if t != ""}


def test_short_lines_against_all_pairs(spark):
    rows = corpus(3)
    text = {d: t for d, t in rows if d is not None}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    seen, repeats = set(), set()
    for d in sorted(text):
        for i, x in enumerate((text[d] or "").split("\n")):
            if 0 < len(w := tuple(x.lower().split())) < 5:
                repeats |= {(d, i)} if w in seen else set()
                seen.add(w)
    assert repeats
    assert {(r["doc"], r["line"]) for r in lines.removed(docs).collect()} == all_pairs(rows) >= repeats


def test_unlike_rows_of_one_id_and_clashing_columns(spark):
    """What goes from one row of an id stays in another; no column's name matters."""
    long = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(4)]
    rows = [(1, long[0]), (2, long[0] + "\n" + long[1]), (2, long[2] + "\n" + long[3]), (2, long[2] + "\n" + long[3]), (3, long[3]), (3, None), (3, "")]
    docs = spark.createDataFrame([(d, t, 1, 2, 3, 4, 5) for d, t in rows], "doc_id long, text string, _lines int, _doc int, _hit int, gone int, th int")
    got = lines.deduplicated(docs, keep_empty=True)
    assert got.columns == docs.columns and {tuple(r)[2:] for r in got.collect()} == {(1, 2, 3, 4, 5)}
    want = [(1, long[0]), (2, long[1]), *[(2, long[2] + "\n" + long[3])] * 2, (3, ""), (3, ""), (3, None)]
    assert sorted([(r["doc_id"], r["text"]) for r in got.collect()], key=str) == sorted(want, key=str)


def test_hashes_do_not_depend_on_chunks(monkeypatch):
    """Long texts are hashed chunk by chunk; words longer than a chunk too."""
    rng = random.Random(3)
    text = " ".join("x" * rng.choice([1, 5, 40, 3000]) + str(rng.random()) for _ in range(400)) + "\n" + "long" * 20_000 + " end"
    want = common.word_hashes(text)
    for chunk in (1, 64, 1000, 1 << 20):
        monkeypatch.setattr(common, "_CHUNK", chunk)
        assert (common.word_hashes(text) == want).all()


def test_word_hashes_tell_words_apart():
    rng = random.Random(6)
    words = ["a" * n for n in range(1, 40)] + ["a" * n + "b" for n in range(40)] + [("x" * 8) * n + "y" * m for n in range(5) for m in range(9) if n + m] + ["z" * 5000, "z" * 5001]
    words = list(dict.fromkeys(words))
    for _ in range(3):
        rng.shuffle(words)
        a = np.frombuffer(" ".join(words).encode(), dtype=np.uint8)
        found = dict(zip(words, lines._word_hashes(a, *common.word_spans(a)).tolist(), strict=True))
        assert len(set(found.values())) == len(words)
        assert found == {w: lines._word_hashes(np.frombuffer(w.encode(), dtype=np.uint8), np.array([0]), np.array([len(w)]))[0] for w in words}
    none = np.array([], dtype=np.int64)
    assert len(lines._word_hashes(np.array([], dtype=np.uint8), none, none)) == 0


def test_words_and_tokens_at_every_byte():
    every = bytes(range(256)) + b"ab" + bytes(reversed(range(256))) + b"z"
    starts, ends = common.word_spans(np.frombuffer(every, dtype=np.uint8))
    assert [every[s:e] for s, e in zip(starts, ends, strict=True)] == every.translate(bytes.maketrans(bytes(range(9, 14)), b" " * 5)).strip(b" ").split()
    assert len(common.word_spans(np.zeros(0, dtype=np.uint8))[0]) == len(lines.tokens([])) == 0
    texts = ["a b c d e f\n\n A  b\tc D e", None, "", "x\ny", "a\n" * 3 + "a b c d e"]
    per_line = [line_set(line) for t in texts for line in (t or "").split("\n")]
    line, h, text_of, number = lines._line_tokens(texts)
    assert [len(set(h[line == k])) for k in range(len(text_of))] == list(map(len, per_line))
    assert text_of.tolist() == [0, 0, 0, 1, 2, 3, 3, 4, 4, 4, 4] and number.tolist() == [0, 1, 2, 0, 0, 0, 1, 0, 1, 2, 3]
    assert sorted(h) == sorted(lines.tokens(texts))
    assert len(set(h)) == len(set().union(*per_line))
