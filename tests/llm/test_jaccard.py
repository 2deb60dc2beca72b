"""The Jaccard join against all pairs, with chunks small enough that every path is taken."""

import random

import pytest

from bazaar.llm import common, graph, jaccard, rarity


def word_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def all_pairs(rows):
    """component_id per row by comparing every pair."""
    sets = [word_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (one, a) in enumerate(zip(rows, sets, strict=True)):
        for j in range(i):
            b = sets[j]
            if one[0] is None or rows[j][0] is None or not a or not b:
                continue
            inter = len(a & b)
            if 100 * inter >= 90 * (len(a) + len(b) - inter):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return [(d, len(s), least.get(find(i)) if d is not None else None) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def corpus(seed, groups=12, copies=14):
    rng, words = random.Random(seed), [f"w{i}" for i in range(400)]
    texts = []
    passage = " ".join(rng.choices(words, k=40))
    for g in range(groups):
        base = rng.choices(words, k=rng.choice([5, 30, 90, 160]))
        for _ in range(rng.randint(1, copies)):
            one = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 45))):
                one[rng.randrange(len(one))] = rng.choice(words)
            text = " ".join(one)
            texts.append(text + (" " + passage if g % 3 == 0 else ""))
    texts += [None, "", " \n", "One  TWO", "one two", "x", "X", "é É", texts[0], texts[0].upper()]
    rng.shuffle(texts)
    return [(i * 3 % 1009, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, None)]


@pytest.mark.parametrize("seed, chunk, pivots", [(1, 1024, 16), (2, 4, 2), (3, 3, 1)])
def test_against_all_pairs(spark, monkeypatch, seed, chunk, pivots):
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    monkeypatch.setattr(jaccard, "PIVOTS", pivots)
    rows = corpus(seed)
    docs = spark.createDataFrame([(d, t, "n", 0) for d, t in rows], "doc_id long, text string, n string, id int").repartition(4)
    got = [tuple(r) for r in jaccard.components(docs).collect()]
    assert sorted(got, key=str) == sorted(all_pairs(rows), key=str)


def test_one_of_each(spark):
    rows = [(3, "a b c d", 1), (1, "A b c  d", 2), (2, "other words in here", 3), (2, "other words in here", 3), (None, "a b c d", 4), (9, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int")
    got = jaccard.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([rows[1], rows[2], rows[4], rows[5]], key=str)
    assert jaccard.components(docs.limit(0)).count() == 0


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7), (2000, 1999)]
    rows = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    root = {r["node"]: r["root"] for r in rows}
    assert all(root[i] == 0 for i in range(1, 61)) and all(root[1000 + i] == 1000 for i in range(1, 50)) and root[2000] == 1999
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_unlike_rows_of_one_id_stay(spark):
    text = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(4)]
    rows = [(1, text[0]), (2, text[0] + " end"), (2, text[1]), (2, text[2]), (2, text[2]), (3, text[2]), (4, None), (4, ""), (None, text[0])]
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, _kept int, node int")
    got = jaccard.one_of_each(docs, 5, 80)
    assert got.columns == docs.columns and {tuple(r)[2:] for r in got.collect()} == {(1, 2)}
    want = [(1, text[0]), (2, text[1]), (2, text[2]), (4, None), (4, ""), (None, text[0])]
    assert sorted([(r["doc_id"], r["text"]) for r in got.collect()], key=str) == sorted(want, key=str)
    assert jaccard.one_of_each(docs.limit(0), 5, 80).count() == 0


def test_counts_add_up_in_any_tree(spark):
    texts = [f"a{i % 7} b{i % 5} c d" for i in range(300)] + [None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    count = lambda parts, fan: rarity.counts(docs.repartition(parts), lambda t: common.word_hashes(t), bits=12, fan=fan)
    want = count(1, 32)
    assert want.sum() == 1200 and all((count(n, fan) == want).all() for n, fan in ((9, 2), (9, 3), (13, 32)))
    assert rarity.counts(docs.limit(0), lambda t: common.word_hashes(t), bits=12).sum() == 0


def test_pairs_are_told_apart_by_their_counts_before_sets_travel(spark, monkeypatch):
    """Of pairs that share a rare shingle and little else, hardly any set is fetched; links stay those of all pairs."""
    fetched, both = {}, jaccard._both

    def watched(pairs, blobs, column):
        fetched[column] = pairs.count()
        return both(pairs, blobs, column)

    monkeypatch.setattr(jaccard, "_both", watched)
    monkeypatch.setattr(jaccard, "CHUNK", 2)
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefgh", k=70)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts + [texts[3] + " a"])]
    found = jaccard.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in found) == sorted(all_pairs(rows))
    assert fetched["parts"] > 50 and fetched["blob"] < fetched["parts"] / 5


def test_shuffle_files_of_earlier_plans_go(spark):
    """Once another plan has run, the files of those before it are deleted."""
    import time
    from pathlib import Path

    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {p for d in folders for p in Path(d).rglob("shuffle_*.data")}
    before = files()
    common.saved(spark.range(5000).repartition(7, "id"), "shuffled")
    mine = files() - before
    assert mine
    spark.range(3).count()
    common.let_go(spark)
    end = time.time() + 30
    while mine & files() and time.time() < end:
        time.sleep(0.2)
    assert not mine & files()
