"""Whole texts as arrays of word hashes, and tables that cut lineage."""

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.session import workspace

WORD = r"[^\x20\x09-\x0D]+"
_CHUNK = 1 << 17  # bytes hashed at a time: its sums stay in a core's cache
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


class _Powers:
    """Powers of the base and of its inverse, as far as any span needed."""

    up = down = np.ones(1, dtype=np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base & _MASK, dtype=np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))
        return cls.up[:n], cls.down[:n]


def as_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of a mask."""
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return edge[::2], edge[1::2]


def word_spans(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words: runs of bytes other than blank, tab, line feed to carriage return."""
    inside = np.zeros(len(a) + 2, dtype=bool)
    np.logical_and(a != 0x20, a - np.uint8(0x09) > 4, out=inside[1:-1])  # bytes below a tab wrap round
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2].copy(), edge[1::2].copy()


def hash_spans(a: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ordered spans of bytes, each by its content alone.

    A polynomial hash from prefix sums: one pass over the bytes for all spans. Long texts go chunk by chunk.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + _CHUNK, side="right")))
        high = ends[to - 1]
        up, down = _Powers.upto(max(4096, int(high - low)))
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(_BYTE[a[low:high]] * up[: high - low], out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (sums[e] - sums[s]) * down[np.minimum(s, len(down) - 1)]
        at = to
    return mixed(out + (ends - starts).astype(np.uint64))


def word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """Hashes of the words of a text in order; lower: with A-Z as a-z first."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    a = np.frombuffer(raw.lower() if lower else raw, dtype=np.uint8)
    return hash_spans(a, *word_spans(a))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k neighbours; of the whole sequence, where it is shorter."""
    if not len(h):
        return h
    k = min(k, len(h))
    n = len(h) - k + 1
    out = np.full(n, k, dtype=np.uint64)
    for i in range(k):
        out = out * np.uint64(_BASE) + h[i : i + n]
        out ^= out >> np.uint64(29)
    return mixed(out)


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return h.view(np.int64)


def split_of(col: Column, parts: int) -> Column:
    """crc32 of an id as text, modulo parts; a null id counts as empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % parts


def saved(df: DataFrame, purpose: str, *partition_by: str) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends, lost executors cost one read."""
    path = workspace(df.sparkSession, purpose)
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let_go(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of plans that have run.

    It deletes them once the driver's garbage is collected, which by itself may come long after the next large shuffle.
    The files of the very last plan stay; another must have run since.
    """
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def large_batches(spark: SparkSession, rows: int = 50_000, size: str = "4MB") -> Iterator[None]:
    """More rows at a time between the JVM and Python while narrow rows are worked on, bounded in bytes."""
    names = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {n: spark.conf.get(n, None) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def slices(texts: list[str | None], rows: int, size: int = 1 << 20) -> Iterator[slice]:
    """The texts in runs of at most `rows` and, beyond the first of a run, about `size` characters."""
    low = total = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > low and (i - low >= rows or total + n > size):
            yield slice(low, i)
            low, total = i, 0
        total += n
    if low < len(texts):
        yield slice(low, len(texts))


def release() -> None:
    """Give a worker's free memory back: it goes on with other work, beside a JVM that needs it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # other C libraries
        ctypes.CDLL(None).malloc_trim(0)


def in_tree(parts: DataFrame, add: Callable[[pd.DataFrame], pd.DataFrame], purpose: str, fan: int = 32) -> DataFrame:
    """Rows (part, data), one per task and numbered by it, added `fan` at a time, level by level, until one row is left.

    add: rows of one group -> one row with any part. However many tasks there are, none holds more than `fan` rows.
    """

    def group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return add(rows).assign(part=key[0])

    parts = saved(parts, purpose)
    n = 1 + (parts.agg(F.max("part").alias("n")).first()["n"] or 0)
    while n > 1:
        n = -(-n // fan)
        parts = parts.withColumn("part", F.floor(F.col("part") / fan).cast("int")).groupBy("part").applyInPandas(group, parts.schema)
    return parts


def with_ids(rows: DataFrame) -> DataFrame:
    """doc_id without nulls, which `_no_id` marks: pandas would make floats of a column that holds one, and round ids."""
    return rows.withColumn("_no_id", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0).cast("long")))


def ids_back(rows: DataFrame) -> DataFrame:
    """Undo with_ids."""
    return rows.withColumn("doc_id", F.when(~F.col("_no_id"), F.col("doc_id"))).drop("_no_id")


def over_batches(
    df: DataFrame, work: Callable[[pd.DataFrame], pd.DataFrame], schema: str, rows: int = 512
) -> DataFrame:
    """mapInPandas in slices of few rows, so that long texts keep a worker's memory bounded.

    Where df has a doc_id (long), work must give one row for each of its rows, in order.
    """
    named = "doc_id" in df.columns

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), rows):
                part = batch.iloc[at : at + rows]
                out = work(part)
                yield out.assign(_no_id=part["_no_id"].to_numpy()) if named else out

    if not named:
        return df.mapInPandas(run, schema)
    return ids_back(with_ids(df).mapInPandas(run, schema + ", _no_id boolean"))
