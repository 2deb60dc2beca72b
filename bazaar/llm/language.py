"""Language identification with hyperdimensional profiles.

Every letter (by code point) and the word boundary has a fixed random vector of +1 and -1. The vectors of an
n-gram's letters, each permuted by its place, are multiplied into one n-gram vector (binding); summed over a text
they are its profile (bundling). A language's prototype is the bundle of all its learning documents, and a
document gets the language whose prototype has the highest cosine with its profile.

A profile is linear in its n-gram counts, so tasks count n-grams and bundle once per slice with one matrix
product. Prototypes are sums: tasks send one integer vector per language, combined in a tree; what reaches the
driver is one vector per language, whatever the corpus.

Defined cases: null text, or none with a letter: `und`, score 0. No learning document: `und` for all. Null or empty
lang never learns. Ties go to the language first in order. Other columns of the input do not enter.
"""

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm import common

DIM = 1024
GRAM = 3
FOLDS, HELD = 4, 2
_SLICE = 64  # documents bundled by one product
_KNOWN = 1 << 15  # n-gram vectors kept by a worker


@lru_cache(1)
def _letters() -> np.ndarray:
    """Code point -> itself in lower case for letters, 0 for anything else."""
    table = np.zeros(0x110000, dtype=np.int64)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def grams(text: str | None) -> np.ndarray:
    """The n-grams of a text as numbers: 21 bits per letter, runs of other characters as one boundary."""
    if not text:
        return np.empty(0, dtype=np.int64)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    s = _letters()[codes]
    s = np.concatenate(([0], s[(s != 0) | np.concatenate(([False], s[:-1] != 0))], [0]))
    if not s.any():
        return np.empty(0, dtype=np.int64)
    if s[-2] == 0:
        s = s[:-1]
    out = np.zeros(max(1, len(s) - GRAM + 1), dtype=np.int64)
    for i in range(GRAM):
        out = (out << 21) | s[i : i + len(out)]
    return out


def _letter_vectors(codes: np.ndarray, dim: int) -> np.ndarray:
    """Random signs per code point, by hashing: the same on every machine."""
    words = dim // 64
    at = codes.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(1, words + 1, dtype=np.uint64)[None, :]
    bits = np.unpackbits(common.mixed(common.mixed(at)).view(np.uint8).reshape(len(codes), -1), axis=1)
    return (bits.astype(np.int8) << 1) - 1


def bound(keys: np.ndarray, dim: int = DIM) -> np.ndarray:
    """Vectors of n-grams: letter vectors rolled by their place, multiplied."""
    out = np.ones((len(keys), dim), dtype=np.int8)
    for i in range(GRAM):
        codes, where = np.unique((keys >> (21 * (GRAM - 1 - i))) & 0x1FFFFF, return_inverse=True)
        out *= np.roll(_letter_vectors(codes, dim), i, axis=1)[where]
    return out


class _Vectors:
    """A worker's n-gram vectors: found by number, started anew when they pass the bound."""

    keys = np.empty(0, dtype=np.int64)
    rows = np.empty((0, DIM), dtype=np.float32)

    @classmethod
    def of(cls, wanted: np.ndarray) -> np.ndarray:
        new = wanted[~np.isin(wanted, cls.keys, assume_unique=True)]
        if len(new):
            if len(cls.keys) + len(new) > _KNOWN:
                cls.keys, cls.rows, new = np.empty(0, np.int64), np.empty((0, DIM), np.float32), wanted
            keys = np.concatenate((cls.keys, new))
            order = np.argsort(keys)
            cls.rows = np.concatenate((cls.rows, bound(new).astype(np.float32)))[order]
            cls.keys = keys[order]
        return cls.rows[np.searchsorted(cls.keys, wanted)]


def profiles(texts: list[str | None]) -> np.ndarray:
    """The bundles of some texts, one row each; all zero where a text has no letter."""
    found = [np.unique(grams(t), return_counts=True) for t in texts]
    keys = np.unique(np.concatenate([k for k, _ in found] or [np.empty(0, np.int64)]))
    out = np.zeros((len(texts), DIM), dtype=np.float32)
    for at in range(0, len(keys), 4096):  # very varied texts: the product in pieces
        part = keys[at : at + 4096]
        counts = np.zeros((len(texts), len(part)), dtype=np.float32)
        for i, (k, c) in enumerate(found):
            lo, hi = np.searchsorted(k, part[0]), np.searchsorted(k, part[-1], side="right")
            counts[i, np.searchsorted(part, k[lo:hi])] = c[lo:hi]
        out += counts @ _Vectors.of(part)
    return out


def _partial(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One task's bundles: n-gram counts per language first, vectors once."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, rows in batch.groupby("lang"):
            for at in range(0, len(rows), 256):
                keys, n = np.unique(
                    np.concatenate([grams(t) for t in rows["text"].iloc[at : at + 256]]), return_counts=True
                )
                total = sums.setdefault(lang, np.zeros(DIM, dtype=np.int64))
                for i in range(0, len(keys), 4096):
                    part = _Vectors.of(keys[i : i + 4096]).astype(np.float64)
                    total += np.rint(n[i : i + 4096].astype(np.float64) @ part).astype(np.int64)
    if sums:
        yield pd.DataFrame({"lang": list(sums), "bundle": [v.tobytes() for v in sums.values()]})


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(DIM, dtype=np.int64)
    for b in rows["bundle"]:
        total += np.frombuffer(b, dtype=np.int64)
    return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "bundle": [total.tobytes()]})


def prototypes(learn: DataFrame, fan: int = 64) -> tuple[list[str], np.ndarray]:
    """Languages in order and their unit prototypes, from all rows of (text, lang)."""
    rows = learn.select("text", "lang").filter("text IS NOT NULL AND lang <> ''").mapInPandas(
        _partial, "lang string, bundle binary"
    )
    once = rows.withColumn("part", F.pmod(F.xxhash64("bundle"), F.lit(fan)))
    level = once.groupBy("lang", "part").applyInPandas(_merged, "lang string, bundle binary")
    tops = level.groupBy("lang").applyInPandas(_merged, "lang string, bundle binary").collect()
    tops = sorted((r["lang"], np.frombuffer(bytes(r["bundle"]), dtype=np.int64).astype(np.float64)) for r in tops)
    tops = [(lang, v) for lang, v in tops if v.any()]
    return [t[0] for t in tops], np.array([v / np.linalg.norm(v) for _, v in tops]).reshape(len(tops), DIM)


def predicted(docs: DataFrame, langs: list[str], units: np.ndarray) -> DataFrame:
    """docs' doc_id with lang_pred and score: the cosine with the nearest prototype, 0 where it is negative."""
    stack = units.astype(np.float32)

    def work(batch: pd.DataFrame) -> pd.DataFrame:
        p = profiles(list(batch["text"]))
        size = np.sqrt((p.astype(np.float64) ** 2).sum(axis=1))
        lang, score = np.full(len(batch), "und", dtype=object), np.zeros(len(batch))
        if langs:
            cos = (p @ stack.T).astype(np.float64) / np.maximum(size, 1e-30)[:, None]
            best = cos.argmax(axis=1)
            some = size > 0
            lang[some] = np.array(langs, dtype=object)[best[some]]
            score[some] = np.clip(cos[np.arange(len(best)), best], 0, 1)[some]
        return pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "lang_pred": lang, "score": score})

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return common.over_batches(rows, work, "doc_id long, lang_pred string, score double", rows=_SLICE)


def identified(docs: DataFrame) -> DataFrame:
    """Every document's language, learnt from the documents outside the held-out fold."""
    fold = common.split_of(F.col("doc_id"), FOLDS)
    langs, units = prototypes(docs.filter(fold != HELD))
    rows = predicted(docs, langs, units)
    return rows.select("doc_id", (fold == HELD).alias("held_out"), "lang_pred", "score")
