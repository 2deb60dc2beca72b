"""A Merkle manifest of a dataset, with the proof of every document, by butterfly exchange.

A leaf is the hash of a document's fields. Within a language the leaves ascend by doc_id, and every FAN consecutive nodes
become one until a single node is left, the subroot; subroots by language likewise give the root.

Leaves are numbered after one range sort and cut into aligned blocks of FAN ** DEPTH, the partitions here. Each block hashes
the tree below its root. Then blocks go round by round: in a round a block swaps the root of its aligned subtree with its
counterparts in the FAN - 1 sibling subtrees, and every one of them hashes the parent. So ancestors are hashed
redundantly, each block gathers the siblings on its own path, and after as many rounds as the tree has levels it can
prove its documents; nothing is handed down from the root. The same rounds go on over the languages. A block
sends and receives a fixed number of digests in a round. Where a subtree at the right end has fewer blocks, each of them
serves several counterparts.

Defined cases: null fields are hashed as `-`, so null and empty differ; a null language comes first, a null doc_id
before all others of its language; rows that share a doc_id are ordered by leaf, equal rows have equal leaves
and any order gives the same tree; an empty table gives no row; columns other than the five fields do not enter.
"""

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm import common

FAN = 8
DEPTH = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_CHUNK = 4096  # receivers of a sender that are listed at once


def field(value: Column) -> Column:
    """Byte count and value, so that fields cannot run into each other."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(**other: Column) -> Column:
    """Hash of a document's fields, some of them replaced."""
    return F.sha2(F.concat(*[field(other.get(c, F.col(c))) for c in FIELDS]).cast("binary"), 256)


def tampered() -> Column:
    """The leaf of a document whose text was changed, null where it was not: a third of the documents in lower case."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(F.coalesce(hit, F.lit(False)), leaf(text=lower))


def numbered(docs: DataFrame, found: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Leaves with their place in the sorted order, and one row per language.

    leaves: doc_id, key, leaf, found (binary), bin, place. languages: key, tree (its number), n (leaves), blocks is added
    later. `place` counts within a bin of the range sort; the rows of one language and bin start at `first` and have
    rank `rank` (in `runs`).
    """
    key = F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), F.col("lang").cast("string")))
    rows = docs.select(
        F.col("doc_id").cast("long"), key.alias("key"), F.unhex(leaf()).alias("leaf"),
        (F.unhex(found) if found is not None else F.lit(None).cast("binary")).alias("found"),
    )
    rows = common.saved(rows, "leaves")  # else the sort's sample would hash all texts once more
    ordered = rows.repartitionByRange("key", F.col("doc_id").asc_nulls_first(), "leaf").sortWithinPartitions("key", F.col("doc_id").asc_nulls_first(), "leaf")
    place = F.monotonically_increasing_id()
    ordered = ordered.withColumn("place", place).withColumn("bin", F.shiftright("place", 33)).withColumn("place", F.col("place").bitwiseAND(F.lit((1 << 33) - 1)))
    ordered = common.saved(ordered, "sorted-leaves")
    runs = ordered.groupBy("key", "bin").agg(F.min("place").alias("first"), F.count("*").alias("n"))  # bins and languages
    runs = common.saved(runs, "runs")
    return ordered, runs


def _before(rows: DataFrame, value: str) -> Column:
    """Sum of `value` over the languages that come before, as bins of their first leaf plus order within that bin."""
    return F.col(f"{value}_bin") + F.coalesce(F.sum(value).over(Window.partitionBy("bin").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def languages(runs: DataFrame, block: int) -> DataFrame:
    """key, n (leaves), tree (number of the language in order), blocks, base (blocks of earlier languages)."""
    own = runs.groupBy("key").agg(F.sum("n").alias("n"), F.min(F.struct("bin", "first")).alias("at")).select("key", "n", "at.*")
    own = own.withColumn("one", F.lit(1)).withColumn("blocks", F.ceil(F.col("n") / block))
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # one row per bin where a language starts
    bins = own.groupBy("bin").agg(F.sum("one").alias("one"), F.sum("blocks").alias("blocks"))
    bins = bins.select("bin", *[F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(f"{c}_bin") for c in ("one", "blocks")])
    own = own.join(bins, "bin")
    own = own.withColumn("tree", _before(own, "one")).withColumn("base", _before(own, "blocks"))
    return common.saved(own.select("key", "n", "tree", "blocks", "base"), "languages")


def digest(nodes: list[bytes]) -> bytes:
    """The parent of a run of nodes."""
    return hashlib.sha256(b"".join(nodes).hex().encode()).digest()


def levels(nodes: list[bytes], whole: int, fan: int, depth: int) -> list[list[bytes]]:
    """The nodes of a block level by level; whole: leaves of its language, which decide how far it goes up."""
    out = [nodes]
    while whole > 1 and len(out) <= depth:
        nodes = [digest(nodes[i : i + fan]) for i in range(0, len(nodes), fan)]
        out.append(nodes)
        whole = -(-whole // fan)
    return out


def _cut(data: bytes | None) -> list[bytes]:
    return [data[i : i + 32] for i in range(0, len(data or b""), 32)]


def blocks(leaves: DataFrame, runs: DataFrame, langs: DataFrame, fan: int, depth: int) -> DataFrame:
    """One row per aligned block: tree, block, n, its leaves packed in order, and its root."""
    earlier = Window.partitionBy("key").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    start = runs.select("key", "bin", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rank"))
    start = start.join(langs.select("key", "tree", F.col("n").alias("whole")), "key")
    ranked = leaves.join(start, ["key", "bin"]).withColumn("rank", F.col("rank") + F.col("place") - F.col("first"))
    size = fan**depth
    ranked = ranked.withColumn("block", F.floor(F.col("rank") / size))
    ranked = ranked.withColumn("none", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        whole = int(rows["whole"].iloc[0])
        top = levels(list(map(bytes, rows["leaf"])), whole, fan, depth)[-1]
        return pd.DataFrame({
            "tree": rows["tree"].iloc[:1], "block": rows["block"].iloc[:1], "whole": whole, "root": [top[0].hex()],
            "ids": [rows["doc_id"].to_numpy().astype("<i8").tobytes()], "none": [rows["none"].to_numpy().astype("u1").tobytes()],
            "leaves": [b"".join(rows["leaf"])], "found": [b"".join(x or b"" for x in rows["found"])],
            "changed": [np.array([x is not None for x in rows["found"]], dtype="u1").tobytes()],
        })

    schema = "tree long, block long, whole long, root string, ids binary, none binary, leaves binary, found binary, changed binary"
    rows = ranked.select("tree", "block", "whole", "rank", "doc_id", "none", "leaf", "found")
    return common.saved(rows.groupBy("tree", "block").applyInPandas(gather, schema), "blocks")


def _round(state: DataFrame, siblings: DataFrame | None, span: int, fan: int) -> DataFrame:
    """One exchange: each block sends its subtree's root to its counterparts in the sibling subtrees and hashes the parent.

    state: id (number of the block), root, proof, and `node`, `lo`, `size` of its subtree: the subtree's number among
    those of its level, its first block and how many blocks it has. siblings: per parent, the subtrees' (node, lo, size),
    given where the caller knows them only from a table; else they follow from the language's own lo and size.
    """
    digit = F.pmod("node", F.lit(fan))
    here = F.col("id") - F.col("lo")
    # Counterparts in a subtree: the blocks there whose place is the sender's, modulo the sender's subtree.
    to = F.transform("others", lambda o: F.struct(o["lo"].alias("lo"), F.floor((o["size"] - here - 1) / F.col("size")).alias("last"), (o["node"] == F.col("node")).alias("own")))
    sent = state.withColumn("others", siblings_of(span, fan) if siblings is None else F.col("others")).withColumn("o", F.explode(F.filter(to, lambda o: o["own"] | (o["last"] >= 0))))
    chunks = F.when(F.col("o.own"), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.floor(F.col("o.last") / _CHUNK)))
    sent = sent.withColumn("chunk", F.explode(chunks))
    within = F.sequence(F.col("chunk") * _CHUNK, F.least(F.col("o.last"), F.col("chunk") * _CHUNK + _CHUNK - 1))
    target = F.when(F.col("o.own"), F.array("id")).otherwise(F.transform(within, lambda k: F.col("o.lo") + here + k * F.col("size")))
    kept = [c for c in state.columns if c not in ("id", "root", "others")]
    sent = sent.select(
        F.explode(target).alias("id"), F.struct(digit.alias("digit"), "root").alias("part"), F.when(F.col("o.own"), F.struct(*kept)).alias("own")
    )
    met = sent.groupBy("id").agg(F.sort_array(F.collect_list("part")).alias("parts"), F.first("own", ignorenulls=True).alias("own"))
    met = met.select("id", "parts", "own.*").withColumn("digit", F.pmod("node", F.lit(fan)))
    level = F.struct(
        F.col("digit").cast("int").alias("at"),
        F.transform(F.filter("parts", lambda p: p["digit"] != F.col("digit")), lambda p: p["root"]).alias("others"),
    )
    parent = F.sha2(F.concat_ws("", F.transform("parts", lambda p: p["root"])).cast("binary"), 256)
    return met.withColumn("proof", F.concat("proof", F.array(level))).withColumn("root", parent).drop("parts", "digit")


def siblings_of(span: int, fan: int) -> Column:
    """(node, lo, size) of the subtrees of `span` blocks under a block's parent, in its own language."""
    last = F.floor((F.col("blocks") - 1) / span)
    low = F.floor(F.col("node") / fan) * fan
    nodes = F.sequence(low, F.least(low + fan - 1, last))
    return F.transform(nodes, lambda q: F.struct(q.alias("node"), (F.col("base") + q * span).alias("lo"), F.least(F.lit(span), F.col("blocks") - q * span).alias("size")))


def exchanged(rows: DataFrame, langs: DataFrame, fan: int) -> DataFrame:
    """id, subroot, root and proof of every block: all levels above it, as its place among the siblings and the others."""
    proof = F.array().cast("array<struct<at:int,others:array<string>>>")
    state = rows.select("tree", "block", "root").join(langs.drop("n", "key"), "tree")
    state = state.select("tree", "blocks", "base", (F.col("base") + F.col("block")).alias("id"), "root", proof.alias("proof"))
    most, trees = langs.agg(F.max("blocks"), F.count("*")).first()
    span = 1
    while span < (most or 0):  # within the languages; one that is a single node rests
        node = F.floor((F.col("id") - F.col("base")) / span)
        at = state.withColumn("node", node).withColumn("lo", F.col("base") + node * span).withColumn("size", F.least(F.lit(span), F.col("blocks") - node * span))
        resting, going = at.filter(F.col("blocks") <= span), at.filter(F.col("blocks") > span)
        state = _round(going, None, span, fan).unionByName(resting.drop("others")).drop("node", "lo", "size")
        state = common.saved(state, "exchange")
        span *= fan
    state = state.withColumn("subroot", F.col("root"))
    width = 1
    while width < trees:  # over the languages
        nodes = langs.groupBy(F.floor(F.col("tree") / width).alias("node")).agg(F.min("base").alias("lo"), F.sum("blocks").alias("size"))
        parents = nodes.groupBy(F.floor(F.col("node") / fan).alias("parent")).agg(F.sort_array(F.collect_list(F.struct("node", "lo", "size"))).alias("others"))
        mine = state.withColumn("node", F.floor(F.col("tree") / width)).withColumn("parent", F.floor(F.col("node") / fan))
        mine = mine.join(parents, "parent").drop("parent")
        own = F.filter("others", lambda o: o["node"] == F.col("node"))[0]
        mine = mine.withColumn("lo", own["lo"]).withColumn("size", own["size"])
        state = common.saved(_round(mine, parents, width, fan).drop("node", "lo", "size"), "exchange")
        width *= fan
    return state


def folded(node: bytes, proof: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that a leaf and the others on its path lead to; proof: per level its place in the run and the others."""
    for at, others in proof:
        node = digest([*others[:at], node, *others[at:]])
    return node


PROOF = "array<struct<at:int,others:array<string>>>"


def _proved(fan: int, depth: int, keep_proof: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Blocks with the levels above them -> one row per document."""

    def work(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for b in batch.itertuples():
            tree = levels(_cut(b.leaves), b.whole, fan, depth)
            above = [(int(p["at"]), [bytes.fromhex(x) for x in p["others"]]) for p in b.proof]
            above_hex = "".join(x for p in b.proof for x in p["others"]).encode()
            found, changed = iter(_cut(b.found)), np.frombuffer(b.changed, dtype="u1")
            ids, none = np.frombuffer(b.ids, dtype="<i8"), np.frombuffer(b.none, dtype="u1")
            for i, own in enumerate(tree[0]):
                path, at = [], i
                for nodes in tree[:-1]:
                    low = at - at % fan
                    run = nodes[low : low + fan]
                    path.append((at - low, run[: at - low] + run[at - low + 1 :]))
                    at //= fan
                seen = next(found) if changed[i] else own
                top = folded(seen, path + above).hex()
                hashed = hashlib.sha256(b"".join(x for _, others in path for x in others).hex().encode() + above_hex).hexdigest()
                row = (int(ids[i]), bool(none[i]), own.hex(), b.subroot, b.top, hashed, top, top == b.top)
                out.append((*row, [{"at": a, "others": [x.hex() for x in o]} for a, o in path + above]) if keep_proof else row)
        names = ["doc_id", "_no_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        return pd.DataFrame(out, columns=names + ["proof"] * keep_proof)

    return work


def manifest(docs: DataFrame, found: Column | None = None, keep_proof: bool = False, fan: int = FAN, depth: int = DEPTH) -> DataFrame:
    """One row per document: leaf, subroot, root, digest of its proof, and whether the document as found leads to the root.

    found: the leaf to verify instead of the document's own, over the columns of `docs`, null where they agree.
    keep_proof adds the proof: per level the document's place in its run, and the run's other nodes.
    """
    leaves, runs = numbered(docs, found)
    langs = languages(runs, fan**depth)
    rows = blocks(leaves, runs, langs, fan, depth)
    upper = exchanged(rows, langs, fan).select("id", "subroot", F.col("root").alias("top"), "proof")
    held = rows.drop("root").join(langs.select("tree", "base"), "tree").withColumn("id", F.col("base") + F.col("block"))
    held = held.join(upper, "id").select("whole", "ids", "none", "leaves", "found", "changed", "subroot", "top", "proof")
    schema = "doc_id long, _no_id boolean, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    work = _proved(fan, depth, keep_proof)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 8):
                yield work(batch.iloc[at : at + 8])

    return common.ids_back(held.mapInPandas(run, schema + f", proof {PROOF}" * keep_proof))
