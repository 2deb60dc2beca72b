"""The manifest against a plain tree: fans and depths, uneven languages, repeated and null ids, changed documents."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from bazaar.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key int, root string, bin int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def leaf_of(r, lower=False):
    doc_id, text, lang, source, n_chars = r
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def climbed(nodes, fan):
    """All levels of the tree over some nodes."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + fan]) for i in range(0, len(out[-1]), fan)])
    return out


def path(tree, i, fan):
    out = []
    for nodes in tree[:-1]:
        low = i - i % fan
        out.append((i - low, nodes[low:i] + nodes[i + 1 : low + fan]))
        i //= fan
    return out


def plain(rows, fan):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[lang] = climbed([leaf_of(r) for r in by[lang]], fan)
    top = climbed([trees[x][-1][0] for x in langs], fan)
    out = []
    for t, lang in enumerate(langs):
        for i, r in enumerate(by[lang]):
            proof = path(trees[lang], i, fan) + path(top, t, fan)
            node = seen = leaf_of(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0)
            for at, others in proof:
                node = h(*others[:at], node, *others[at:])
            subroot, root = trees[lang][-1][0], top[-1][0]
            out.append((r[0], leaf_of(r), subroot, root, h(*[x for _, o in proof for x in o]), node, node == root))
            assert (node == root) == (seen == leaf_of(r))
    return out


NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", 1) for r in rows], SCHEMA).repartition(5)


def table(seed, sizes):
    rng = random.Random(seed)
    rows = [
        (rng.randrange(10**12), rng.choice(["Ab c", "x", "Ünd É", "", "a" * 3000 + "B", None, "A\nB"]), lang, rng.choice([None, "", "s1"]), rng.choice([None, 3]))
        for lang, n in sizes.items() for _ in range(n)
    ]
    rows += rows[:3] + [(rows[0][0], "other", *rows[0][2:]), (None, "No Id", "en", None, None), (None, None, None, None, None), (2**60 + 1, "Q", "en", "s", 1)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "fan, depth, sizes",
    [
        (2, 1, {"en": 37, "de": 1, "": 9, None: 5, "fr": 2, "é": 16}),
        (3, 1, {"en": 100, "de": 27, "z": 28}),
        (8, 3, {"en": 700, "de": 1}),
        (2, 2, {"only": 1}),
        (3, 2, {str(i): 1 + i % 4 for i in range(30)}),
    ],
)
def test_against_a_plain_tree(spark, fan, depth, sizes):
    rows = table(fan * 10 + depth, sizes)
    docs = frame(spark, rows)
    got = merkle.manifest(docs, merkle.tampered(), fan=fan, depth=depth)
    assert sorted(map(tuple, got.select(NAMES).collect()), key=str) == sorted(plain(rows, fan), key=str)


def test_proofs_hold_on_their_own(spark):
    rows = table(5, {"en": 60, "de": 3})
    got = merkle.manifest(frame(spark, rows), keep_proof=True, fan=3, depth=2).collect()
    assert all(r.verified and r.folded_root == r.root for r in got)
    for r in got:
        proof = [(p["at"], [bytes.fromhex(x) for x in p["others"]]) for p in r.proof]
        assert merkle.folded(bytes.fromhex(r.leaf), proof).hex() == r.root
        assert merkle.folded(bytes(32), proof).hex() != r.root
    assert len({r.root for r in got}) == 1


def test_uneven_subtrees_have_many_receivers(spark, monkeypatch):
    monkeypatch.setattr(merkle, "_CHUNK", 2)
    rows = table(9, {"a": 65, "b": 1, "c": 17})
    got = merkle.manifest(frame(spark, rows), merkle.tampered(), fan=2, depth=1)
    assert sorted(map(tuple, got.select(NAMES).collect()), key=str) == sorted(plain(rows, 2), key=str)


def test_empty_and_single(spark):
    assert merkle.manifest(frame(spark, []).limit(0)).count() == 0
    one = merkle.manifest(frame(spark, [(3, "A", None, None, None)])).first()
    assert one.leaf == one.subroot == one.root and one.proof_sha256 == h("")
    changed = merkle.manifest(frame(spark, [(3, "A", None, None, None)]), F.lit(h("x"))).first()
    assert not changed.verified and changed.folded_root == h("x")
