"""Keys that may be in a set: a bitmap of fixed size that keeps rows without a partner out of a shuffle."""

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm import common

BITS = 27


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    return (common.mixed(keys.astype(np.int64).view(np.uint64) + np.uint64(11)) >> np.uint64(64 - bits)).astype(np.int64)


def may_hold(keys: DataFrame, column: str, bits: int = BITS, fan: int = 32):
    """A test for long columns: false only for values that `keys` does not have.

    2 to the number of bits decides how many wrong yeses there are, which cost the caller a longer way, never a result.
    """

    def mark(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bitmap, some = np.zeros(1 << (bits - 3), dtype=np.uint8), 0
        for batch in batches:
            at = _places(batch["key"].to_numpy(), bits)
            np.bitwise_or.at(bitmap, at >> 3, (1 << (at & 7)).astype(np.uint8))
            some += len(batch)
        if some:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "bits": [zlib.compress(bitmap.tobytes(), 1)]})

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        bitmap = np.zeros(1 << (bits - 3), dtype=np.uint8)
        for data in rows["bits"]:
            bitmap |= np.frombuffer(zlib.decompress(data), dtype=np.uint8)
        return pd.DataFrame({"part": [0], "bits": [zlib.compress(bitmap.tobytes(), 1)]})

    schema = "part int, bits binary"
    wanted = keys.select(F.col(column).cast("long").alias("key")).filter("key IS NOT NULL")
    top = common.in_tree(wanted.mapInPandas(mark, schema), join, "bitmaps", fan).collect()  # one row
    packed = bytes(top[0]["bits"]) if top else zlib.compress(bytes(1 << (bits - 3)), 1)
    shared = keys.sparkSession.sparkContext.broadcast(packed)

    @F.pandas_udf("boolean")
    def test(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bitmap = np.frombuffer(zlib.decompress(shared.value), dtype=np.uint8)
        for keys in batches:
            at = _places(keys.to_numpy(), bits)
            yield pd.Series(((bitmap[at >> 3] >> (at & 7)) & 1).astype(bool))

    def may(col: Column) -> Column:
        # pandas would make floats of a column with a null, and round its keys.
        key = col.cast("long")
        return key.isNotNull() & test(F.coalesce(key, F.lit(0).cast("long")))

    return may
