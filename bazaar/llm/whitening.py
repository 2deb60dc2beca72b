"""Embedding whitening from an exact, bit-sliced scatter.

Entries become integers, x = floor(SCALE * c). The distinct integer vectors are the fit list. Per batch of rows each
dimension is shifted to its own least value there, and bit b of all rows of the batch is packed into 64-bit words: one
bit plane per dimension and bit. The sum over rows of a product is then the sum over planes of 2^(a+b) times the number
of ones in the AND of two planes; undoing the shift gives the cross-products of x itself. Batches add up as integers, in
limbs of 40 bits, so sums are exact whatever the magnitude and the order. Only the matrix of the dimensions comes to the
driver: it is centred there as integers (n * sum of products - product of sums) before it becomes floating point and goes
to eigh.

Defined cases: rows whose vector is null, empty or holds null or non-finite entries give no result; so do vectors of
another length than most of the table have (the longer one among equals). Repeated rows count once in the fit and each
have a result; entries beyond 62 bits after scaling are held at that bound, deviations beyond 38 digits are null. Components without variance (equal vectors,
dependent dimensions: eigenvalue below 1e-12 of the trace) are not returned; an empty table gives none. Only vec_id
and the vector are read.
"""

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.llm import common

SCALE = 256
COMPONENTS = 4
ROWS = 65_536  # rows of a batch whose planes are held at a time, as many words as planes allow
_WORDS = 1 << 22  # words of all planes of a batch
_LIMB = 40
_LIMBS = 4
_BOUND = float(1 << 62)


def vectors(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows of usable vectors by length: (their indices, the matrix of them as double)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy()).astype(np.int64)
    valid = column.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0)
    flat = column.values  # of the whole buffer, which offsets point into
    numbers = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    starts = column.offsets.to_numpy()[:-1]
    out = {}
    for size in np.unique(sizes[valid]):
        rows = np.flatnonzero(valid & (sizes == size))
        matrix = numbers[starts[rows][:, None] + np.arange(size)]
        fine = np.isfinite(matrix).all(axis=1)
        if fine.any():
            out[int(size)] = (rows[fine], matrix[fine])
    return out


def quantized(matrix: np.ndarray) -> np.ndarray:
    """x = floor(SCALE * c) as int64."""
    with np.errstate(over="ignore"):  # the product of a finite entry may be infinite, and is then held at the bound
        return np.clip(np.floor(matrix * SCALE), -_BOUND, _BOUND).astype(np.int64)


def _coded(x: np.ndarray) -> list[bytes]:
    """One short key per vector: two bytes an entry where they suffice for the vector, else eight."""
    small = (np.abs(x) < 1 << 15).all(axis=1)
    two = x.astype("<i2")
    return [(two[i] if small[i] else x[i].astype("<i8")).tobytes() for i in range(len(x))]


def _decoded(keys: list[bytes], size: int) -> np.ndarray:
    out = np.empty((len(keys), size), dtype=np.int64)
    short = np.fromiter((len(k) == 2 * size for k in keys), dtype=bool, count=len(keys))
    for width, kind in ((True, "<i2"), (False, "<i8")):
        at = np.flatnonzero(short == width)
        if len(at):
            out[at] = np.frombuffer(b"".join(keys[i] for i in at), dtype=kind).reshape(len(at), size)
    return out


def planes(y: np.ndarray, bits: int) -> np.ndarray:
    """[dimension, bit, word]: the bits of non-negative entries, 64 rows to a word."""
    n, size = y.shape
    words = -(-n // 64)
    out = np.zeros((size, bits, words * 8), dtype=np.uint8)
    columns = np.ascontiguousarray(y.T)
    for b in range(bits):
        packed = np.packbits(((columns >> b) & 1).astype(np.uint8), axis=1, bitorder="little")
        out[:, b, : packed.shape[1]] = packed
    return out.view("<u8")


def scattered(x: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Exact sums per dimension, and cross-products of dimension i with those from i on, as Python integers."""
    n, size = x.shape
    low = x.min(axis=0)
    y = (x.astype(np.uint64) - low.astype(np.uint64)).astype(np.uint64)  # below 2^63, also where x spans all bits
    bits = max(1, int(y.max()).bit_length())
    plane = planes(y, bits)
    weights = [1 << b for b in range(bits)]
    wide = 2 * bits + n.bit_length() > 62
    scale = np.array(weights, dtype=object if wide else np.int64)
    ones = np.bitwise_count(plane).sum(axis=2, dtype=np.int64)
    sums_y = [sum(int(c) * w for c, w in zip(row, weights, strict=True)) for row in ones]
    shift = [int(v) for v in low]
    sums = [s + n * m for s, m in zip(sums_y, shift, strict=True)]
    cross = []
    for i in range(size):
        total = 0
        for a in range(bits):
            both = np.bitwise_count(plane[i:] & plane[i, a]).sum(axis=2, dtype=np.int64)  # [dimension, bit]
            total = total + (both.astype(scale.dtype) * scale).sum(axis=1) * weights[a]
        row = [int(v) for v in np.atleast_1d(total)]
        cross.append([v + shift[i] * sums_y[j] + shift[j] * sums_y[i] + n * shift[i] * shift[j] for j, v in enumerate(row, i)])
    return sums, cross


def _limbs(value: int) -> list[int]:
    """Signed limbs: all but the last below 2^_LIMB and not negative."""
    out = []
    for _ in range(_LIMBS - 1):
        out.append(value & ((1 << _LIMB) - 1))
        value >>= _LIMB
    return [*out, value]


_COLUMNS = ", ".join(f"l{k} long" for k in range(_LIMBS))


@dataclass
class Fit:
    """What a whitening needs: all of the size of the dimensions."""

    n: int
    sums: list[int]
    low: list[int]
    high: list[int]
    values: np.ndarray  # eigenvalues of the kept components, falling
    vectors: np.ndarray  # [dimension, component], unit
    trace: float

    def projected(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows: centred, rotated, scaled. Centred as integers where 62 bits hold them."""
        sums, top = np.array(self.sums, dtype=object), max(map(abs, [*self.low, *self.high, 1]))
        if 2 * top * self.n < 1 << 62:
            centred = (x * self.n - sums.astype(np.int64)).astype(np.float64) / self.n
        else:
            centred = ((x.astype(object) * self.n - sums) / self.n).astype(np.float64)
        return centred @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Exact sums over the dimensions of (n * x - sum)^2; null beyond 38 digits."""
        kind = pa.decimal128(38, 0)
        most = max(max(abs(self.n * v - s) for v in (a, b)) for a, b, s in zip(self.low, self.high, self.sums, strict=True))
        if len(self.sums) * most * most < 1 << 62:
            d = x * self.n - np.array(self.sums, dtype=np.int64)
            return pa.array((d * d).sum(axis=1)).cast(kind)
        d = x.astype(object) * self.n - np.array(self.sums, dtype=object)
        return pa.array([Decimal(v) if v < 10**38 else None for v in (d * d).sum(axis=1)], kind)


def fitted_rows(rows: DataFrame, column: str) -> tuple[DataFrame, int]:
    """The distinct integer vectors of the length that most rows have, coded, and that length."""

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, (_, matrix) in vectors(batch.column(0)).items():
                keys = _coded(quantized(matrix))
                yield pa.RecordBatch.from_arrays([pa.array([size] * len(keys), pa.int32()), pa.array(keys, pa.binary())], names=["size", "x"])

    coded = rows.select(column).mapInArrow(code, "size int, x binary")
    # Counted before the shuffle, so a vector that many rows hold is one row per task.
    counted = common.saved(coded.groupBy("size", "x").agg(F.count("*").alias("n")), "distinct-vectors")
    sizes = counted.groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    size = sizes["size"] if sizes else 0
    return counted.filter(F.col("size") == size).select("x"), size


def scatter(distinct: DataFrame, size: int) -> tuple[int, list[int], list[list[int]], list[int], list[int]]:
    """n, sums, cross-products (upper triangle) and the least and largest entry per dimension, exact."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cross, low, high, held = 0, [0] * size, None, None, None, []

        def flush() -> None:
            nonlocal n, sums, cross, low, high
            keys = [k for part in held for k in part]
            held.clear()
            most = ROWS
            while keys:
                x = _decoded(keys[:most], size)
                spread = int((x.max(axis=0).astype(object) - x.min(axis=0)).max())
                fits = max(64, _WORDS // (size * max(1, spread.bit_length())) * 64)
                if len(x) > fits:  # many or wide dimensions: fewer rows at a time
                    most = fits
                    continue
                s, c = scattered(x)
                n += len(x)
                sums = [a + b for a, b in zip(sums, s, strict=True)]
                cross = c if cross is None else [[a + b for a, b in zip(p, q, strict=True)] for p, q in zip(cross, c, strict=True)]
                low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
                keys = keys[most:]

        count = 0
        for batch in batches:
            held.append(batch.column(0).to_pylist())
            count += batch.num_rows
            if count >= ROWS:
                flush()
                count = 0
        flush()
        if n:
            out = [(-1, -1, *_limbs(n), 0, 0)]
            out += [(i, -1, *_limbs(s), int(low[i]), int(high[i])) for i, s in enumerate(sums)]
            out += [(i, j, *_limbs(v), 0, 0) for i, row in enumerate(cross) for j, v in enumerate(row, i)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if k < 2 else pa.int64()) for k, c in enumerate(zip(*out, strict=True))],
                names=["i", "j", *[f"l{k}" for k in range(_LIMBS)], "low", "high"],
            )

    parts = distinct.mapInArrow(work, f"i int, j int, {_COLUMNS}, low long, high long")
    added = parts.groupBy("i", "j").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(_LIMBS)], F.min("low").alias("low"), F.max("high").alias("high"))
    n, sums, low, high = 0, [0] * size, [0] * size, [0] * size
    cross = [[0] * (size - i) for i in range(size)]
    for r in added.collect():  # one row per pair of dimensions
        value = sum(r[f"l{k}"] << (_LIMB * k) for k in range(_LIMBS))
        if r["i"] < 0:
            n = value
        elif r["j"] < 0:
            sums[r["i"]], low[r["i"]], high[r["i"]] = value, r["low"], r["high"]
        else:
            cross[r["i"]][r["j"] - r["i"]] = value
    return n, sums, cross, low, high


def covariance(n: int, sums: list[int], cross: list[list[int]]) -> np.ndarray:
    """Centred as integers, then one correctly rounded division per entry."""
    size = len(sums)
    out = np.zeros((size, size))
    for i, row in enumerate(cross):
        for j, v in enumerate(row, i):
            out[i, j] = out[j, i] = (n * v - sums[i] * sums[j]) / (n * n)
    return out


def fit(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> tuple[Fit | None, DataFrame, int]:
    """The fit, the distinct vectors that it is over, and their length; no fit without usable vectors."""
    distinct, size = fitted_rows(rows, column)
    if not size:
        return None, distinct, size
    n, sums, cross, low, high = scatter(distinct, size)
    v = covariance(n, sums, cross)
    unit = max(np.abs(v).max(), np.finfo(float).tiny)  # scaled, so that squares of large entries stay finite
    values, axes = np.linalg.eigh(v / unit)
    order = np.argsort(-values)[:components]
    order = order[values[order] > 1e-12 * values.clip(0).sum()]
    axes = axes[:, order]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)  # the largest entry is positive
    return Fit(n, sums, low, high, values[order] * unit, axes, float(np.trace(v))), distinct, size


def identity_error(distinct: DataFrame, size: int, fitted: Fit) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, from the whitened rows."""
    k = len(fitted.values)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = fitted.projected(_decoded(batch.column(0).to_pylist(), size))
            first, second = first + w.sum(axis=0), second + w.T @ w
        entries = [*zip([-1] * k, range(k), first, strict=True), *((i, j, second[i, j]) for i in range(k) for j in range(k))]
        kinds = (pa.int32(), pa.int32(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*entries, strict=True), kinds, strict=True)], names=["i", "j", "v"])

    mean, cov = np.zeros(k), np.zeros((k, k))
    for r in distinct.mapInArrow(work, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # k * (k + 1) rows
        if r["i"] < 0:
            mean[r["j"]] = r["v"] / fitted.n
        else:
            cov[r["i"], r["j"]] = r["v"] / fitted.n
    return float(np.abs(cov - np.outer(mean, mean) - np.eye(k)).max())


def whitened(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation (decimal), whitened, explained and identity_error per row and component."""
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    fitted, distinct, size = fit(rows, column, components)
    if fitted is None or not len(fitted.values):
        return rows.sparkSession.createDataFrame([], schema)
    error, k = identity_error(distinct, size, fitted), len(fitted.values)
    explained = fitted.values / fitted.trace

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, matrix = vectors(batch.column(1)).get(size, (None, None))
            if at is None:
                continue
            x = quantized(matrix)
            n = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * k, fitted.n)), fitted.deviations(x).take(pa.array(np.repeat(np.arange(n), k))),
                    pa.array(fitted.projected(x).ravel()), pa.array(np.tile(explained, n)), pa.array(np.full(n * k, error)),
                ],
                names=[c.split()[0] for c in schema.split(", ")],
            )

    return rows.select(F.col("vec_id").cast("long"), column).mapInArrow(work, schema)
