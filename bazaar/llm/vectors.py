"""Embedding near-dedup: an exact metric range join, and its components.

On unit vectors, cosine >= t is Euclidean distance <= r with r^2 = 2 - 2t. Pivots partition the vectors: a vector's home
is the cell of its nearest pivot. A partner of x may live in cell q only if x is near enough to it: the triangle
inequality gives d(x, q) - d(x, home) <= 2r, and in Euclidean space the distance to the plane between two pivots gives
the sharper (d(x, q)^2 - d(x, home)^2) / (2 d(home, q)) <= r. Those vectors are replicated to q as boundary. Each cell
is then joined alone, in pairs of bounded blocks, so a crowded cell is more pairs of blocks, not one large task. Every
pair is seen in the home cell of each of its vectors, which counts its links there; pairs are not returned, only counts
and a spanning forest.

How many pivots pay depends on the data: with clusters many, with directionless vectors few, since nearly every vector
is near every boundary then. The number is chosen by estimated comparisons and replicas on a bounded sample.

Equal vectors are one class first. Products are screened in single precision, with a margin above its error, and
decided in double precision.

Defined cases: vectors that are null, zero, or hold null or non-finite components link with nothing, as do rows without
vec_id and vectors of different length with each other; repeated rows are vectors of their own (they link); other
columns do not enter; an empty table gives none.
"""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm import common, graph
from bazaar.operators.joins import keyed_join

COSINE = 0.95
SAMPLE = 2_048  # vectors that pivots are drawn from and costs are estimated on
LEAST_PIVOTS, MOST_PIVOTS = 8, 1_024
BLOCK = 8_192
_TILE = 512


def usable() -> Column:
    """Rows that can link."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in double precision."""
    x = rows.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def replicas(cos: np.ndarray, pivots: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """Home per vector, and which other cells it must be in: cos are the vectors' products with the pivots."""
    home = cos.argmax(axis=1)
    apart = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))
    near = cos[np.arange(len(cos)), home]
    also = near[:, None] - cos <= radius * apart[home] + 1e-9
    also[np.arange(len(cos)), home] = False
    return home, also


def chosen(drawn: np.ndarray, n: int, radius: float) -> np.ndarray:
    """The first so many of the drawn vectors as pivots, by the lowest estimated cost for n vectors."""
    apart: list[int] = []  # pivots nearer than the radius to each other part nothing
    for i in range(-(-len(drawn) // 2)):
        if not apart or (2 - 2 * drawn[apart] @ drawn[i] > radius * radius).all():
            apart.append(i)
    sample, drawn = drawn[len(drawn) // 2 :], drawn[apart]  # costs are estimated on vectors that are no pivots
    best, at = float("inf"), 1
    most = min(len(drawn), MOST_PIVOTS)
    for k in sorted({min(most, LEAST_PIVOTS << i) for i in range(12)}):
        pivots = drawn[:k]
        home, also = replicas(sample @ pivots.T, pivots, radius)
        share = len(sample) / n if n else 1
        core = np.bincount(home, minlength=k) / share
        members = core + also.sum(axis=0) / share
        # Products at 10 G a second, rows at 100 MB a second through a shuffle, a cell at 5 ms.
        cost = (core * members).sum() * drawn.shape[1] / 1e10 + members.sum() * (drawn.shape[1] * 4 + 40) / 1e8 + k * 5e-3
        if cost < best:
            best, at = cost, k
    return drawn[:at]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.empty((0, 0))


def _placed(pivots: dict[int, np.ndarray], radius: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Classes -> one row per cell they are in: their home (core), and as boundary."""

    def work(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for dim, rows in batch.groupby("dim"):
            raw = _matrix(rows["embedding"])
            home, also = replicas(unit(raw) @ pivots[dim].T, pivots[dim], radius)
            data = [r.astype("<f8").tobytes() if raw.dtype == np.float64 else r.astype("<f4").tobytes() for r in raw]
            which, cell = np.nonzero(also)
            at, cells = np.concatenate((np.arange(len(rows)), which)), np.concatenate((home, cell))
            out.append(
                pd.DataFrame({
                    "dim": int(dim), "cell": cells, "core": np.arange(len(at)) < len(rows), "id": rows["id"].to_numpy()[at],
                    "m": rows["m"].to_numpy()[at], "data": [data[i] for i in at],
                })
            )
        return pd.concat(out)

    return work


_BLOCK = "dim int, cell int, core boolean, part long, ids binary, ms binary, data binary"


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    """One block: its ids, how often each vector occurs, and the vectors, as three values."""
    rows = rows.sort_values("id")
    first = rows.iloc[0]
    return pd.DataFrame({
        "dim": [first["dim"]], "cell": [first["cell"]], "core": [first["core"]], "part": [first["part"]],
        "ids": [rows["id"].to_numpy(np.int64).tobytes()], "ms": [rows["m"].to_numpy(np.int64).tobytes()],
        "data": [b"".join(rows["data"])],
    })


def _opened(data: bytes, n: int, dim: int) -> np.ndarray:
    return unit(np.frombuffer(data, dtype="<f8" if len(data) == 8 * n * dim else "<f4").reshape(n, dim))


def pairs_within(x: np.ndarray, y: np.ndarray, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) with x[i] . y[j] >= cosine, a slice of x at a time."""
    x4, y4 = x.astype(np.float32), y.astype(np.float32)
    margin = 1e-6 + 4e-7 * x.shape[1]
    for low in range(0, len(x), _TILE):
        product = x4[low : low + _TILE] @ y4.T
        flat = np.flatnonzero(product.ravel() >= cosine - margin)
        i, j = np.divmod(flat, len(y))
        unsure = product.ravel()[flat] < cosine + margin
        ok = ~unsure
        for at in np.array_split(np.flatnonzero(unsure), max(1, int(unsure.sum()) // 65536)):
            ok[at] = (x[low + i[at]] * y[j[at]]).sum(axis=1) >= cosine
        yield low + i[ok], j[ok]


def _joined(cosine: float) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Pairs of blocks -> per vector its links (weighted by occurrences) and one edge of a spanning forest."""

    def one(row) -> pd.DataFrame:
        a_ids, b_ids = np.frombuffer(row.ids_a, np.int64), np.frombuffer(row.ids_b, np.int64)
        a_m, b_m = np.frombuffer(row.ms_a, np.int64), np.frombuffer(row.ms_b, np.int64)
        same = row.core_b and row.part_a == row.part_b
        x = _opened(row.data_a, len(a_ids), row.dim)
        y = x if same else _opened(row.data_b, len(b_ids), row.dim)
        n_a, n_b = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
        base = 0 if same else len(a_ids)
        root = np.arange(len(a_ids) if same else len(a_ids) + len(b_ids))
        for i, j in pairs_within(x, y, cosine):
            if same:
                i, j = i[i != j], j[i != j]
            n_a += np.bincount(i, weights=b_m[j], minlength=len(a_ids)).astype(np.int64)
            if row.core_b and not same:
                n_b += np.bincount(j, weights=a_m[i], minlength=len(b_ids)).astype(np.int64)
            root = graph.forest(root[i], root[base + j], len(root))[root]
        ids = a_ids if same else np.concatenate((a_ids, b_ids))
        n = n_a if same else np.concatenate((n_a, n_b))
        some = np.flatnonzero((n > 0) | (root != np.arange(len(root))))
        return pd.DataFrame({"id": ids[some], "n": n[some], "root": ids[root[some]]})

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                yield one(row)

    return run


def linked(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """The contract's columns: vec_id, n_links, component_id, kept."""
    radius = float(np.sqrt(2 - 2 * cosine)) + 1e-7
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding").withColumn("_ok", usable())
    good = rows.filter("_ok")
    classes = good.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("m"))
    classes = common.saved(classes.withColumn("dim", F.size("embedding")), "vectors")
    sizes = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    pivots = {}
    for dim, n in sizes.items():
        drawn = classes.filter(F.col("dim") == dim).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("embedding").collect()
        pivots[dim] = chosen(unit(np.array([r[0] for r in drawn])), n, radius)
    schema = "dim int, cell int, core boolean, id long, m long, data binary"
    placed = common.saved(
        common.over_batches(classes.select("dim", "id", "m", "embedding"), _placed(pivots, radius), schema, 4096), "cells"
    )
    key = ["dim", "cell", "core"]
    parts = placed.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    spread = keyed_join(placed, parts, key, "inner").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    blocks = spread.drop("parts").groupBy(*key, "part").applyInPandas(_block, _BLOCK)
    blocks = common.saved(blocks, "blocks")
    side = lambda s: [F.col(c).alias(f"{c}_{s}") for c in ("core", "part", "ids", "ms", "data")]
    a, b = blocks.filter("core").select("dim", "cell", *side("a")), blocks.select("dim", "cell", *side("b"))
    # Within a cell, blocks of its own vectors meet once; those of its boundary meet every block of its own.
    plan = a.select("dim", "cell", "part_a").join(b.select("dim", "cell", "core_b", "part_b"), ["dim", "cell"])
    plan = plan.filter("NOT core_b OR part_a <= part_b").repartition("dim", "cell", "part_a", "core_b", "part_b")
    met = plan.join(a, ["dim", "cell", "part_a"]).join(b, ["dim", "cell", "core_b", "part_b"])
    met = met.select("dim", "core_b", "part_a", "part_b", "ids_a", "ms_a", "data_a", "ids_b", "ms_b", "data_b")
    found = common.saved(met.mapInPandas(_joined(cosine), "id long, n long, root long"), "found")
    roots = graph.components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    per_class = keyed_join(classes.select("embedding", "id", "m"), counts, ["id"], "left")
    per_class = keyed_join(per_class, roots.withColumnRenamed("node", "id"), ["id"], "left").select(
        "embedding", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id")
    )
    out = keyed_join(good.select("vec_id", "embedding"), per_class, ["embedding"], "inner").drop("embedding")
    alone = rows.filter("NOT _ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def kept(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """The rows, with all their columns, that represent their component."""
    stay = linked(vectors, cosine).filter("kept").select(F.col("vec_id").alias("_vec_id")).distinct()
    return vectors.join(stay, F.col("vec_id").cast("long").eqNullSafe(F.col("_vec_id")), "left_semi")
