"""Snapshot collapse against comparing every pair of conversations."""

import random

import pytest

from bazaar.llm import chat


def plain(rows):
    talks = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            talks.setdefault(conv, []).append(((turn is None, turn or 0), role or "", text or ""))
    talks = {c: tuple((r, t) for _, r, t in sorted(x)) for c, x in talks.items()}
    out = {}
    for c, x in talks.items():
        if any(len(y) > len(x) and y[: len(x)] == x for y in talks.values()):
            continue
        same = [d for d, y in talks.items() if y == x]
        body = "".join(f"<|{r}|>\n{t.replace('<|', '< |').replace('|>', '| >')}\n" for r, t in x)
        out[min(same)] = (len(x), len(same), body)
    return out


@pytest.mark.parametrize("part", [4096, 3])
def test_collapse(spark, monkeypatch, part):
    monkeypatch.setattr(chat, "PART", part)
    rng = random.Random(7)
    rows = []
    for c in range(60):
        stem = rng.choice([["hi"], ["hello", "yes <|x|>"], ["hi", "no"]])
        talk = stem + [rng.choice("ab") for _ in range(rng.randint(0, 9))]
        rows += [(c, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(talk)]
    rows += [(None, 0, "user", "x"), (100, None, None, None), (101, 5, "user", ""), (102, 5, "user", ""), (102, 5, "user", "")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, rank int").repartition(3)
    got, parts = {}, {}
    for r in chat.rendered(frame).orderBy("conv_id", "part").collect():
        parts.setdefault(r["conv_id"], []).append(r["part"])
        n, s, body = got.get(r["conv_id"], (0, 0, ""))
        got[r["conv_id"]] = (r["n_turns"], r["n_snapshots"], body + r["text"])
    assert got == plain(rows)
    assert all(p == list(range(len(p))) for p in parts.values())
    assert chat.rendered(frame.limit(0)).count() == 0
