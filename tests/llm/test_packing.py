"""Packing: ids against the tokenizer itself, gapless sequences, plan against the lower bound."""

import bisect
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bazaar.llm import packing

TEXTS = [None, "", "Hello  World.\n\tIt's <|endoftext|> x́y \xa0ÄÖ 漢字 12 345", "a" * 5000, "\n", "one two\x0bthree\x85four ̈"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.vocabulary())


def direct(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_encoder(tokenizer):
    got = packing.Encoder(packing.vocabulary()).encode(TEXTS)
    assert [[*g, 0] for g in got] == [direct(tokenizer, t) for t in TEXTS]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80))
def test_encoder_on_any_text(text):
    e = packing.encoder(packing.vocabulary())
    assert list(e.encode([text])[0]) == e.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("cached", [0, 3, 10**6])
def test_encoder_forgets_and_goes_on(tokenizer, monkeypatch, cached):
    monkeypatch.setattr(packing, "_CACHED", cached)
    e, rng = packing.Encoder(packing.vocabulary()), random.Random(3)
    words = ["ab", "ab,", "ab.", "é.", "É,", "a×.", "1.", "x..", ",", ".", "it's,", "<|endoftext|>.", "<", "ﬁ.", "ñandú,", "漢.", "\t", "a\tb,", "”."]
    for _ in range(40):
        texts = [rng.choice([" ", "\n", "  "]).join(rng.choice(words) for _ in range(rng.randrange(9))) for _ in range(4)]
        assert [[*g, 0] for g in e.encode(texts)] == [direct(tokenizer, t) for t in texts]


def test_encoder_keeps_chunks_that_come_again(monkeypatch):
    monkeypatch.setattr(packing, "_CACHED", 6)
    e, asked = packing.Encoder(packing.vocabulary()), []
    encoded = e._encoded
    monkeypatch.setattr(e, "_encoded", lambda chunks: asked.extend(chunks) or encoded(chunks))
    for text in ("ab cd", "ab ef", "gh ij kl mn", "ab gh"):  # the third is one too many: those that came once go
        e.encode([text])
    assert asked.count("ab") == 1 and sorted(set(asked)) == ["ab", "cd", "ef", "gh", "ij", "kl", "mn"]


def test_long_texts_in_parts(tokenizer, monkeypatch):
    e, rng = packing.Encoder(packing.vocabulary()), random.Random(9)
    texts = ["".join(rng.choice(["ab", "cd,", "é.", "x" * 30, " ", " ", "\n", "  "]) for _ in range(n)) for n in (0, 1, 7, 60, 300)] + [" " * 50, "y" * 90, None]
    for long in (1, 5, 20, 64):
        monkeypatch.setattr(packing, "_LONG", long)
        assert [[*g, 0] for g in e.encode(texts)] == [direct(tokenizer, t) for t in texts]


def test_tokenizers_that_join_across_blanks_get_whole_texts():
    other = packing.Encoder(packing.vocabulary().replace("word_bpe_49k", "byte_bpe_50k"))
    assert packing.Encoder(packing.vocabulary()).by_chunk and not other.by_chunk
    assert [g.tolist() for g in other.encode(TEXTS)] == [other.tokenizer.encode(t or "", add_special_tokens=False).ids for t in TEXTS]


def best_fit_decreasing(histogram):
    rooms = []
    for x in sorted((k for k, v in histogram.items() for _ in range(v)), reverse=True):
        at = bisect.bisect_left(rooms, x)
        room = rooms.pop(at) if at < len(rooms) else 2048
        bisect.insort(rooms, room - x)
    return len(rooms)


def test_plan_uses_everything_tightly():
    rng = random.Random(1)
    histogram = {rng.randint(1, 2048): rng.randint(1, 40) for _ in range(300)}
    bins = packing.plan(histogram)
    used = {}
    for chosen, times in bins:
        assert sum(k * n for k, n in chosen.items()) <= 2048
        for k, n in chosen.items():
            used[k] = used.get(k, 0) + n * times
    assert used == histogram
    assert sum(t for _, t in bins) <= best_fit_decreasing(histogram)


def test_fullest_is_exact():
    rng = random.Random(2)
    for _ in range(50):
        lengths = sorted({rng.randint(3, 30): rng.randint(1, 3) for _ in range(5)}.items(), reverse=True)
        room = rng.randint(1, 70)
        sums = {0}
        for x, n in lengths:
            sums = {s + x * k for s in sums for k in range(n + 1) if s + x * k <= room}
        got = packing.fullest(lengths, room)
        assert sum(x * n for x, n in got) == max(sums) and all(n <= dict(lengths)[x] for x, n in got)


def test_packed(spark, tokenizer):
    rows = [(i, t, "x") for i, t in enumerate([*TEXTS, "word " * 5000, "same", "same"])] + [(7, "same", None), (None, "q", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(3)
    got = packing.packed(docs, packing.vocabulary(), keep_ids=True).toPandas()
    for doc_id, text, _ in rows[:7]:
        mine = got[got["doc_id"] == doc_id].sort_values("piece")
        want = direct(tokenizer, text)
        assert [x for ids in mine["ids"] for x in ids] == want and list(mine["start"]) == list(range(0, len(want), 2048))
        assert all(c == zlib.crc32(np.array(i, "<u4").tobytes()) for c, i in zip(mine["ids_crc32"], mine["ids"], strict=True))
    assert (got["doc_id"] == 7).sum() == 2 and got["doc_id"].isna().sum() == 1
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert list(s["offset"]) == [0, *s["length"].cumsum()[:-1]] and s["length"].sum() <= 2048
    assert got["sequence_id"].nunique() <= -(-got["length"].sum() // 2048) + 1
    assert packing.packed(docs.limit(0), packing.vocabulary()).count() == 0
