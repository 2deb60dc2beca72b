"""N-gram Jaccard join: documents whose sets of word shingles are nearly equal, and their components.

The join is rare-first prefix filtering. Shingles are ordered by frequency in the corpus (rarity.py), rarest first;
two sets can only reach the threshold if they share one of the first few of each, so only those meet, on the shingle,
under a length filter and a positional filter. Pairs are verified once, after a suffix filter: both sets are cut into
sixteen ranges of hashes, and the differences of the counts bound their overlap.

Only links between different sets matter, and of those only what they connect. So equal sets become one class first.
Classes that share prefix shingles are then dealt into chunks around a common partner; a chunk's sets are compared with
each other inside one task, which returns a spanning forest. Large neighbourhoods are several chunks, all of which also
get the same few pivots, so that their forests grow together. What is left are pairs from different chunks that
are not connected yet: they go through the join proper. No group of copies is expanded into pairs, no pair
with a link is lost, and a chunk has a bounded number of sets.

Defined cases: null or blank text has an empty set, linked with nothing; rows without doc_id link with nothing and get
a null component; rows that share a doc_id are documents of their own under one name; an empty table gives none; only doc_id and text are read.
"""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.llm import bitmap, common, graph, rarity
from bazaar.operators.joins import keyed_join

SHINGLE = 3
PERCENT = 90
CHUNK = 1024
PIVOTS = 16
_PARTS = 16


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles of a text, ascending."""
    return np.unique(common.windows(common.word_hashes(text, lower=True), k))


def prefix_length(n: int, percent: int) -> int:
    """How many of a set's first elements must be looked at to meet every partner."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _signature(s: np.ndarray) -> tuple[int, int]:
    one = common.mixed(s + np.uint64(1)).sum(dtype=np.uint64)
    two = common.mixed(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def _compact(s: np.ndarray) -> bytes:
    """36 bits of every shingle: counts of sixteen ranges, then 32 bits each."""
    short = np.unique(s >> np.uint64(28))
    parts = np.bincount((short >> np.uint64(32)).astype(np.int64), minlength=_PARTS).astype("<u4")
    return parts.tobytes() + (short & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()


def _opened(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    parts = np.frombuffer(data, dtype="<u4", count=_PARTS).astype(np.int64)
    low = np.frombuffer(data, dtype="<u4", offset=4 * _PARTS).astype(np.uint64)
    return parts, low | (np.repeat(np.arange(_PARTS, dtype=np.uint64), parts) << np.uint64(32))


def similar(inter: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    return 100 * inter >= percent * (na + nb - inter)


def sets_of(docs: DataFrame, k: int, percent: int, order: np.ndarray) -> DataFrame:
    """doc_id, n, two signatures of the set, and its prefix in the rare-first order."""
    table = docs.sparkSession.sparkContext.broadcast(order)  # fixed size

    def work(batch: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            s = shingles(text, k)
            first = rarity.rare_first(s, table.value)[: prefix_length(len(s), percent)]
            rows.append((doc_id, len(s), *_signature(s), common.signed(first)))
        out = pd.DataFrame(rows, columns=["doc_id", "n", "sig", "sig2", "prefix"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    schema = "doc_id long, n long, sig long, sig2 long, prefix array<long>"
    return common.over_batches(docs.select(F.col("doc_id").cast("long"), "text"), work, schema)


def _length_filter(percent: int, a: Column, b: Column) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _within(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Component index of each set of one chunk: every pair is compared, set against all at a time."""
    n = np.array([len(s) for s in sets], dtype=np.int64)
    values, where = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(n)[:-1]))
    holds, a, b = np.zeros(len(values), dtype=np.uint8), [], []
    for i in range(len(sets) - 1):
        mine = where[starts[i] : starts[i] + n[i]]
        holds[mine] = 1
        rest = np.add.reduceat(holds[where[starts[i + 1] :]], starts[i + 1 :] - starts[i + 1], dtype=np.int64)
        holds[mine] = 0
        found = np.flatnonzero(similar(rest, n[i], n[i + 1 :], percent)) + i + 1
        a += [i] * len(found)
        b += found.tolist()
    return graph.forest(np.array(a, dtype=np.int64), np.array(b, dtype=np.int64), len(sets))


def _by_group(batches: Iterable[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Groups of rows that arrive sorted by key, across batches."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = batch[key].iloc[-1]
        for value, rows in batch.groupby(key, sort=False):
            if held and held[0][key].iloc[0] != value:
                yield pd.concat(held)
                held = []
            held.append(rows)
            if value != last:
                yield pd.concat(held)
                held = []
    if held:
        yield pd.concat(held)


def _chunked(k: int, percent: int) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Chunks of documents -> their compact sets and forest edges."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def opened() -> Iterator[pd.DataFrame]:
            for batch in batches:
                for low in range(0, len(batch), 256):
                    part = batch.iloc[low : low + 256]
                    found = [shingles(t, k) for t in part["text"]]
                    same = [_signature(s)[0] == w for s, w in zip(found, part["sig"], strict=True)]
                    yield part[["chunk", "id", "pivot"]].assign(set=found)[same]

        for rows in _by_group(opened(), "chunk"):
            root = rows["id"].to_numpy()[_within(list(rows["set"]), percent)] if len(rows) > 1 else rows["id"]
            out = rows[["id"]].assign(root=root, blob=[_compact(s) for s in rows["set"]])
            out.loc[rows["pivot"].to_numpy(), "blob"] = None
            yield out
        common.release()

    return run


def _hopeful(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Suffix filter: pairs whose counts by range leave room for enough common shingles."""

    def work(batch: pd.DataFrame) -> pd.DataFrame:
        pa, pb = (np.frombuffer(b"".join(batch[c]), dtype="<u4").astype(np.int64).reshape(-1, _PARTS) for c in ("parts_a", "parts_b"))
        total = pa.sum(axis=1) + pb.sum(axis=1)
        most = (total - np.abs(pa - pb).sum(axis=1)) // 2
        return batch.loc[(100 + percent) * most >= percent * total, ["a", "b"]]

    return work


def _verify(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def work(batch: pd.DataFrame) -> pd.DataFrame:
        keep = []
        for one, other in zip(batch["blob_a"], batch["blob_b"], strict=True):
            (_, a), (_, b) = _opened(one), _opened(other)
            keep.append((100 + percent) * len(np.intersect1d(a, b, assume_unique=True)) >= percent * (len(a) + len(b)))
        return batch.loc[np.array(keep, dtype=bool), ["a", "b"]]

    return work


def _both(pairs: DataFrame, blobs: DataFrame, column: str) -> DataFrame:
    """Pairs with a column of both their documents."""
    for side in ("a", "b"):
        pairs = pairs.join(blobs.select(F.col("id").alias(side), F.col(column).alias(f"{column}_{side}")), side)
    return pairs.select("a", "b", f"{column}_a", f"{column}_b")


def linked(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n_shingles, component_id) per row, and the (node, root) table behind it."""
    rows = docs.filter("doc_id IS NOT NULL")
    order = rarity.counts(rows, lambda t: common.windows(common.word_hashes(t, lower=True), k))
    sets = common.saved(sets_of(docs, k, percent, order), "sets")
    key = ["n", "sig", "sig2"]
    narrow = sets.select("doc_id", *key).filter("doc_id IS NOT NULL AND n > 0")
    classes = common.saved(narrow.groupBy(*key).agg(F.min("doc_id").alias("id")), "classes")

    # Prefix entries of one document per class, where another class shares the shingle.
    entries = (
        keyed_join(sets.select("doc_id", *key, "prefix"), classes, key, "inner").filter("doc_id = id")
        .select("id", "n", "sig", F.posexplode("prefix").alias("pos", "token"))
    )
    shared = entries.groupBy("token").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high")
    entries = common.saved(keyed_join(entries, shared.select("token", "low"), ["token"], "inner"), "entries")

    # Neighbourhoods around the smallest partner, dealt into chunks.
    near = entries.groupBy("id", "sig").agg(F.min("low").alias("around"))
    size = near.groupBy("around").agg(F.count("*").alias("size"))
    spread = lambda parts, salt: F.pmod(F.xxhash64("id", F.lit(salt)), parts)
    near = keyed_join(near, size, ["around"], "inner").filter("size > 1")
    near = near.withColumn("parts", F.ceil(F.col("size") / CHUNK))
    member = near.select(
        "id", "sig", "around", "parts", spread(F.col("parts"), 1).alias("part"),
        ((F.col("parts") > 1) & (spread(F.ceil(F.col("size") / PIVOTS), 2) == 0)).alias("is_pivot"),
    )
    member = common.saved(member, "members")
    chunk = F.xxhash64("around", "part").alias("chunk")
    others = F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda x: x != F.col("part")))
    pivots = member.filter("is_pivot").select("id", "sig", "around", others.alias("part"))
    dealt = member.select("id", "sig", chunk, F.lit(False).alias("pivot")).unionByName(
        pivots.select("id", "sig", chunk, F.lit(True).alias("pivot"))
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    grouped = texts.filter(bitmap.may_hold(member, "id")(F.col("id"))).join(dealt, "id").repartition("chunk").sortWithinPartitions("chunk")
    grouped = grouped.select("chunk", "id", "pivot", "sig", "text")
    common.let_go(docs.sparkSession)
    done = common.saved(grouped.mapInPandas(_chunked(k, percent), "id long, root long, blob binary"), "chunks")
    edges = done.select(F.col("id").alias("a"), F.col("root").alias("b"))
    roots = graph.components(edges)
    common.let_go(docs.sparkSession)

    # Pairs from different chunks that nothing connects yet: the join proper.
    placed = member.select("id", chunk).join(roots.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.select("id", "chunk", F.coalesce("root", "id").alias("root"))
    open_ = entries.select("id", "n", "pos", "token").join(placed, "id", "left")
    open_ = open_.select("id", "n", "pos", "token", F.coalesce("chunk", "id").alias("chunk"), F.coalesce("root", "id").alias("root"))
    spanned = open_.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    open_ = common.saved(keyed_join(open_, spanned.select("token"), ["token"], "inner"), "open")
    by_root = open_.groupBy("token", "root").agg(F.count("*").alias("c"))
    main = by_root.groupBy("token").agg(F.max_by("root", F.struct("c", "root")).alias("main"))
    few = keyed_join(open_, main, ["token"], "inner").filter("root <> main")
    a = few.select("token", *[F.col(c).alias(f"{c}_a") for c in ("id", "n", "pos", "chunk", "root", "main")])
    b = open_.select("token", *[F.col(c).alias(f"{c}_b") for c in ("id", "n", "pos", "chunk", "root")])
    fits = (
        (F.col("root_a") != F.col("root_b")) & (F.col("chunk_a") != F.col("chunk_b"))
        & ((F.col("root_b") == F.col("main_a")) | (F.col("id_a") < F.col("id_b")))
        & _length_filter(percent, F.col("n_a"), F.col("n_b"))
        & (F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) * (100 + percent)
           >= (F.col("n_a") + F.col("n_b")) * percent)
    )
    pairs = keyed_join(a, b, ["token"], "inner", fits)
    pairs = pairs.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()
    blobs = _blobs(done, docs, pairs := common.saved(pairs, "pairs"), k)
    common.let_go(docs.sparkSession)
    # The few counts travel first, and whole sets only for the pairs that they leave.
    parts = blobs.select("id", F.substring("blob", 1, 4 * _PARTS).alias("parts"))
    pairs = common.over_batches(_both(pairs, parts, "parts"), _hopeful(percent), "a long, b long").distinct()
    pairs = common.saved(pairs, "hopeful-pairs")
    late = common.over_batches(_both(pairs, blobs, "blob"), _verify(percent), "a long, b long")
    late = common.saved(late, "links")
    if late.limit(1).count():
        roots = graph.components(edges.unionByName(late))
    nodes = keyed_join(classes, roots.withColumnRenamed("node", "id"), ["id"], "left")
    nodes = common.saved(nodes.select(*key, F.coalesce("root", "id").alias("class_root")), "class-roots")
    out = keyed_join(sets.select("doc_id", *key), nodes, key, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_root", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")), roots


def _blobs(done: DataFrame, docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """Compact sets of the documents in pairs: those that a chunk has made, and the rest from their texts."""
    wanted = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = common.saved(wanted, "wanted")
    may = bitmap.may_hold(wanted, "id")
    have = common.saved(done.filter("blob IS NOT NULL").filter(may(F.col("id"))).select("id", "blob"), "blobs")
    lacking = common.saved(wanted.join(have.select("id"), "id", "left_anti"), "lacking")
    may = bitmap.may_hold(lacking, "id")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text").filter(may(F.col("id"))).join(lacking, "id")

    def work(batch: pd.DataFrame) -> pd.DataFrame:
        return batch[["id"]].assign(blob=[_compact(shingles(t, k)) for t in batch["text"]])

    return have.unionByName(common.saved(common.over_batches(texts, work, "id long, blob binary"), "late-blobs"))


def components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The contract's columns."""
    return linked(docs, k, percent)[0]


def one_of_each(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents without near duplicates: of each component the row with the smallest doc_id stays.

    Rows without doc_id stay. Where ids repeat, rows are told apart: unlike rows of one id stay both, equal ones once.
    """
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = F.col("doc_id").isNotNull()
    repeats = rows.filter(known).groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
    if repeats:  # numbers of rows, fixed by writing them; equal rows share one
        numbers = rows.filter(known).select("doc_id", F.xxhash64("text").alias("th")).distinct().withColumn("node", F.monotonically_increasing_id())
        numbers = common.saved(numbers, "numbered-rows")
        rows = keyed_join(rows.withColumn("th", F.xxhash64("text")), numbers, ["doc_id", "th"])
    else:
        rows = rows.withColumn("node", F.col("doc_id"))
    found = components(rows.select(F.col("node").alias("doc_id"), "text"), k, percent).filter("doc_id IS NOT NULL")
    found = found.select(F.col("doc_id").alias("node"), "component_id").distinct()
    if repeats:
        first = F.min(F.struct("doc_id", "node")).alias("first")
        kept = keyed_join(found, numbers, ["node"], "inner").groupBy("component_id").agg(first).select("first.node")
    else:
        kept = found.filter("node = component_id").select("node")
    some = keyed_join(rows, common.saved(kept, "kept-rows"), ["node"], "left_semi").select("row", "node")
    if repeats:  # equal rows of a node
        some = some.groupBy("node").agg(F.min_by("row", F.md5(F.to_json("row"))).alias("row"))
    out = some.select("row").unionByName(rows.filter("node IS NULL").select("row"))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in names])
