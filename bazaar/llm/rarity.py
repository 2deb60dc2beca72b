"""How frequent hashed tokens are in the whole corpus, in a table of fixed size."""

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from bazaar.llm import common

BITS = 20


def bucket(h: np.ndarray, bits: int = BITS) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def _packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<u4").tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype="<u4").astype(np.int64)


def counts(
    texts: DataFrame, tokens: Callable[[str | None], np.ndarray] | Callable[[list[str | None]], np.ndarray], bits: int = BITS, fan: int = 32,
    many: bool = False,
) -> np.ndarray:
    """Tokens of all rows of `text` counted by the first bits of their hash.

    Tokens of one bucket count together, so a bucket bounds each of its tokens from above. Every task counts into one
    array; the arrays are added in a tree. The result has 2 to the number of bits entries, whatever the corpus.
    `many`: `tokens` takes a list of texts.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = np.zeros(1 << bits, dtype=np.int64), []
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for run in common.slices(texts, 128):
                part = texts[run]
                held += [tokens(part)] if many else [tokens(t) for t in part]
                if sum(map(len, held)) >= 1 << bits:  # a count costs as much as the table is long
                    total += np.bincount(bucket(np.concatenate(held), bits), minlength=1 << bits)
                    held = []
        if held:
            total += np.bincount(bucket(np.concatenate(held), bits), minlength=1 << bits)
        held.clear()
        common.release()
        packed = _packed(np.minimum(total, 2**32 - 1))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([packed], pa.binary())], names=["part", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << bits, dtype=np.int64)
        for data in rows["counts"]:
            total += _unpacked(data)
        return pd.DataFrame({"part": [0], "counts": [_packed(np.minimum(total, 2**32 - 1))]})

    parts = texts.select("text").mapInArrow(count, "part int, counts binary")
    top = common.in_tree(parts, add, "token-counts", fan).collect()  # one row
    return _unpacked(bytes(top[0]["counts"])) if top else np.zeros(1 << bits, dtype=np.int64)


def rare_first(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The tokens in the global order: rarer buckets first, then by hash."""
    bits = len(table).bit_length() - 1
    return h[np.lexsort((h, table[bucket(h, bits)]))]
