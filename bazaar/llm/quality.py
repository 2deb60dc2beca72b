"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document: its failure is one bit of `failures`, and what it measured is kept
beside it. A policy is a versioned set of rules, that is one mask: applying it, comparing versions and asking
what one rule alone costs are bitwise operations over the ledger, without reading a text again.

Defined cases: a null or empty text has no words and fails `few_words`; equal rows give equal rows; columns of
the input other than doc_id and text are left out of the ledger, so no name clashes; an empty table gives none.
"""

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm import common

#: Rule -> condition under which a document fails, in the order of the bits. New rules go to the end.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "word_length": "word_chars < 2 * n_words OR word_chars > 14 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 30 * n_lines",
    "words_without_letters": "100 * n_bare_words > 30 * n_words",
    "capitals": "100 * n_capitals > 50 * n_letters",
    "exclamations": "100 * n_exclamations > 30 * n_words",
}
BASE = ("few_words", "repeated_windows")
#: Policy version -> the rules it applies.
POLICIES: dict[str, tuple[str, ...]] = {"base": BASE, "v1": BASE + ("symbols", "duplicate_lines"), "v2": tuple(RULES)}

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_bare_words", "n_letters", "n_capitals", "n_exclamations",
)
WINDOW = 8


def _table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


_SYMBOL, _EXCLAIM = _table(b"#*$%&|<>"), _table(b"!?")
_CAPITAL = _table(bytes(range(65, 91)))
_LETTER = _CAPITAL | _table(bytes(range(97, 123))) | _table(bytes(range(0xC0, 256)))
_BLANK = _table(b" \t\n\v\f\r")
_HEAD = ~_table(bytes(range(0x80, 0xC0)))  # bytes that begin a code point


def measured(text: str | None) -> tuple[int, ...]:
    """The MEASURES of one text, each from whole-array operations."""
    a = common.as_bytes(text)
    if not len(a):
        return (0,) * len(MEASURES)
    starts, ends = common.word_spans(a)
    n = len(starts)
    bytes_of = np.bincount(a, minlength=256)
    cuts = np.flatnonzero(a == 10)
    line_starts, line_ends = np.concatenate(([0], cuts + 1)), np.concatenate((cuts, [len(a)]))
    words_before = np.searchsorted(starts, np.concatenate((line_starts, [len(a)])))
    with_word = words_before[1:] > words_before[:-1]
    lines = common.hash_spans(a, line_starts[with_word], line_ends[with_word])
    return (
        n,
        int(bytes_of[_HEAD].sum() - bytes_of[_BLANK].sum()),
        int(bytes_of[_SYMBOL].sum()),
        len(lines) - len(np.unique(lines)),
        _in_repeated_windows(common.hash_spans(a, starts, ends)) if n > WINDOW else 0,
        len(lines),
        int((np.maximum.reduceat(_LETTER.view(np.uint8)[a], starts) == 0).sum()) if n else 0,
        int(bytes_of[_LETTER].sum()),
        int(bytes_of[_CAPITAL].sum()),
        int(bytes_of[_EXCLAIM].sum()),
    )


def _in_repeated_windows(words: np.ndarray) -> int:
    """Words inside windows that the text holds twice or more."""
    runs = common.windows(words, WINDOW)
    ordered = np.sort(runs)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(runs, twice))
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    cover[at] += 1
    cover[at + WINDOW] -= 1
    return int((np.cumsum(cover) > 0).sum())


def _measures(batch: pd.DataFrame) -> pd.DataFrame:
    rows = np.array([measured(t) for t in batch["text"]], dtype=np.int64).reshape(len(batch), len(MEASURES))
    out = pd.DataFrame(rows, columns=list(MEASURES))
    out.insert(0, "doc_id", batch["doc_id"].to_numpy())
    return out


def mask_of(rules: tuple[str, ...]) -> int:
    return sum(1 << list(RULES).index(r) for r in rules)


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, every measurement, and `failures` with one bit per rule."""
    schema = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)
    rows = common.over_batches(docs.select(F.col("doc_id").cast("long"), "text"), _measures, schema)
    bits = [F.when(F.expr(rule), F.lit(1 << i).cast("long")).otherwise(0) for i, rule in enumerate(RULES.values())]
    return rows.withColumn("failures", reduce(lambda x, y: x.bitwiseOR(y), bits))


def failed(policy: str, failures: str = "failures") -> Column:
    """Whether a document fails a policy version."""
    return F.col(failures).bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long")) != 0


def kept(rows: DataFrame, policy: str) -> DataFrame:
    """The ledger rows that a policy version keeps."""
    return rows.filter(~failed(policy))


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and that the policy without it keeps.

    The ledger is first counted by distinct mask: at most 2 to the number of rules, whatever the corpus.
    """
    whole = mask_of(POLICIES[policy])
    masks = rows.groupBy(F.col("failures").bitwiseAND(F.lit(whole).cast("long")).alias("m")).agg(F.count("*").alias("n"))
    rules = [F.struct(F.lit(r).alias("rule"), F.lit(mask_of((r,))).cast("long").alias("bit")) for r in POLICIES[policy]]
    each = masks.select("m", "n", F.explode(F.array(*rules)).alias("r")).select("m", "n", "r.*")
    count = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0))
    rest = F.lit(whole).cast("long").bitwiseXOR(F.col("bit"))
    return each.groupBy("rule").agg(
        count(F.col("m").bitwiseAND(F.col("bit")) != 0).alias("fails"),
        count(F.col("m") == F.col("bit")).alias("fails_alone"),
        count(F.col("m").bitwiseAND(rest) == 0).alias("kept_without"),
    )


def digest(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """The contract's columns, with the ledger's mask beside them."""
    return ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed("base").alias("base_failed"), (~(failed("base") | failed(policy))).alias("kept"), "failures",
    )
