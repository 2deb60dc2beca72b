"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target in words, so each of its documents has the same expected number of copies: a whole part,
and a fraction that must become 0 or 1. Pivotal rounding takes two fractional documents and moves expected words
from one to the other, at random but fairly, until one is whole; the other goes on to meet the next. Words are
moved one for one, so a source's total stays at its target until one last document is left, which a draw decides:
the words taken differ from the target by less than that document. Residuals combine in a tree: groups of about
`GROUP` units by a hash of their id, then groups of residuals, until one per source is left; a source that owns
most of the corpus is just more groups.

A unit is the rows that share doc_id, source and size (one row, where ids are unique). Of n rows with probability p, the
whole part of n * p rows is settled at once, and only the fraction of one row enters the tree; the rows that get a copy
more are the first by a hash of their text. Draws come from hashes of the ids, so reruns agree.

Defined cases: null text has size 0; documents without words are never taken; null source is a source, the last
one; an empty table gives none; only doc_id, source and text are read, other columns pass through `mixed`.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm import common
from bazaar.operators.joins import keyed_join

GROUP = 16_384
FAN = 1_024
CYCLE = 3  # weights 1, 2, 3, repeating
LIMIT = 3  # copies of a document at most
_WHOLE = 1e-9


def size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(common.WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) with `target`: shares by weight, none above LIMIT times its size.

    With every source either at its limit or at level x weight, the level follows from the sources in the order
    of limit / weight: those at their limit come first. One row per source is windowed, never documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    upto, rest = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    limit, weight = F.col("source_size") * LIMIT, F.col("weight")
    rows = (
        sizes.withColumn("weight", 1 + (F.row_number().over(by_name) - 1) % CYCLE)
        .withColumn("ratio", limit / weight)
        .withColumn("total", F.sum("source_size").over(Window.partitionBy()))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum(limit).over(upto), F.lit(0))) / F.sum("weight").over(rest))
        .withColumn("at_limit", F.col("level") >= F.col("ratio"))
    )
    level = F.min(F.when(~F.col("at_limit"), F.struct("ratio", "level"))).over(Window.partitionBy())["level"]
    share = F.when(F.col("at_limit"), limit.cast("double")).otherwise(F.least(limit.cast("double"), weight * F.col("_level")))
    return rows.withColumn("_level", level).select("source", "source_size", share.alias("target"))


def settled(a: np.ndarray, p: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, int]:
    """Pivotal rounding of probabilities p with weights a, in order; the place of the residual, or -1.

    The returned values are 0 or 1 but for the residual's.
    """
    out, at = p.astype(float).copy(), -1
    for i in range(len(a)):
        if out[i] < _WHOLE or out[i] > 1 - _WHOLE:
            out[i] = round(out[i])
            continue
        if at < 0:
            at = i
            continue
        up = min(a[at] * (1 - out[at]), a[i] * out[i])
        down = min(a[at] * out[at], a[i] * (1 - out[i]))
        move = up if draw[i] * (up + down) < down else -down
        out[at] += move / a[at]
        out[i] -= move / a[i]
        rest = -1
        for j in (at, i):
            if _WHOLE <= out[j] <= 1 - _WHOLE:
                rest = j
            else:
                out[j] = round(out[j])
        at = rest
    return out, at


_UNIT = "doc_id long, source string, n_words long, weight long, whole long, n long, more long, p double, bucket long, _no_id boolean"


def _level(rows: pd.DataFrame) -> pd.DataFrame:
    """One group: all of its units whole but at most one."""
    key = np.where(rows["_no_id"], -1, rows["doc_id"]).astype(np.int64).view(np.uint64)
    key = common.mixed(key ^ common.mixed(rows["n_words"].to_numpy(dtype=np.int64).view(np.uint64) + np.uint64(1)))
    order = np.lexsort((rows["n_words"].to_numpy(), key))
    rows, key = rows.iloc[order], key[order]
    draw = common.mixed(key + np.uint64(7)).astype(np.float64) / 2.0**64
    out, _ = settled(rows["weight"].to_numpy(dtype=float), rows["p"].to_numpy(), draw)
    return rows.assign(p=out)


def copies(sizes: DataFrame, shares: DataFrame) -> DataFrame:
    """(doc_id, source, n_words, copies, n, more) per unit, of rows (doc_id, source, n_words) and their sources' targets.

    Each of the unit's n rows has `copies`, and `more` of them have one copy more.
    """
    rate = F.least(F.lit(float(LIMIT)), F.col("target") / F.col("source_size"))
    units = sizes.filter("n_words > 0").groupBy("doc_id", "source", "n_words").agg(F.count("*").alias("n"))
    units = _with_source(units, shares).withColumn("rate", rate)
    expected = F.col("n") * (F.col("rate") - F.floor("rate"))  # rows with a copy more
    groups = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / GROUP))
    rows = units.select(
        "doc_id", "source", "n_words", F.col("n_words").alias("weight"), F.floor("rate").alias("whole"),
        "n", F.floor(expected).alias("more"), (expected - F.floor(expected)).alias("p"),
        F.pmod(F.xxhash64("doc_id", "n_words"), groups).alias("bucket"),
    )
    rows = common.with_ids(rows)
    most = shares.agg(F.max("n_docs").alias("n")).first()["n"] or 0
    buckets, done = max(1, -(-most // GROUP)), []
    while True:
        level = common.saved(rows.groupBy("source", "bucket").applyInPandas(_level, _UNIT), "mixing")
        whole = (F.col("p") == 0) | (F.col("p") == 1)
        done.append(level.filter(whole))
        rest = level.filter(~whole)
        if buckets == 1:
            break
        buckets = -(-buckets // FAN)
        rows = rest.withColumn("bucket", F.col("bucket") % buckets)
    done, rest = [common.ids_back(d) for d in done], common.ids_back(rest)
    draw = F.pmod(F.xxhash64("source", "doc_id", "n_words"), F.lit(1 << 30)) / float(1 << 30)
    done.append(rest.withColumn("p", F.when(draw < F.col("p"), 1.0).otherwise(0.0)))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    more = F.col("more") + F.col("p").cast("long")
    every = more == F.col("n")  # then all rows have it
    return out.select("doc_id", "source", "n_words", (F.col("whole") + every.cast("long")).alias("copies"), "n", F.when(every, 0).otherwise(more).alias("more"))


def _with_source(rows: DataFrame, shares: DataFrame) -> DataFrame:
    side = shares.withColumnRenamed("source", "_source")
    return rows.join(side, rows["source"].eqNullSafe(side["_source"]), "left").drop("_source")


_BINS = 4_096  # of the rows of a unit


def _with_copies(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows (doc_id, source, n_words, order, ...) with their copies. `order` ranks the rows of a unit."""
    names = ("doc_id", "source", "n_words")
    side = found.withColumnsRenamed({n: f"_{n}" for n in names})
    on = [rows[n].eqNullSafe(side[f"_{n}"]) for n in names]
    joined = rows.join(side, on, "left").drop(*[f"_{n}" for n in names])
    joined = joined.withColumn("copies", F.coalesce("copies", F.lit(0)).cast("long"))
    split = F.coalesce(F.col("more"), F.lit(0)) > 0
    if not found.filter("more > 0").limit(1).count():
        return joined.drop("order", "n", "more")
    # Rows of a unit that differ in copies: whole bins of the hash first, then the first rows of one bin.
    some = joined.filter(split).withColumn("_bin", F.pmod("order", F.lit(_BINS)))
    key = [F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), F.coalesce("source", F.lit("")), F.col("source").isNull(), F.col("n_words")]
    some = some.withColumn("_unit", F.struct(*[k.alias(f"k{i}") for i, k in enumerate(key)]))
    sizes = some.groupBy("_unit", "_bin").agg(F.count("*").alias("_size"))
    before = Window.partitionBy("_unit").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)  # at most _BINS rows
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    # Both scans see the same bins, as a bin follows from the row alone.
    some = keyed_join(some, sizes, ["_unit", "_bin"], "inner").withColumn("_room", F.col("more") - F.col("_before"))
    cut = (F.col("_room") > 0) & (F.col("_room") < F.col("_size"))
    nth = F.row_number().over(Window.partitionBy("_unit", "_bin").orderBy("order"))
    partly = some.filter(cut).withColumn("_extra", (nth <= F.col("_room")).cast("long"))
    wholly = some.filter(~cut).withColumn("_extra", (F.col("_room") >= F.col("_size")).cast("long"))
    plain = joined.filter(~split)
    done = partly.unionByName(wholly).withColumn("copies", F.col("copies") + F.col("_extra")).select(*plain.columns)
    return plain.unionByName(done).drop("order", "n", "more")


def decided(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, source, n_words) per row, the sources' targets, and the copies per unit."""
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), size().alias("n_words"), F.xxhash64("text").alias("order"))
    sizes = common.saved(narrow, "sizes")
    per = sizes.groupBy("source").agg(F.sum("n_words").alias("source_size"), F.count("*").alias("n_docs"))
    per = common.saved(per, "sources")
    shares = common.saved(targets(per.drop("n_docs")), "targets")
    side = per.select(F.col("source").alias("_source"), "n_docs")
    shares = shares.join(side, shares["source"].eqNullSafe(side["_source"])).drop("_source")
    return sizes, shares, copies(sizes, shares)


def taken(docs: DataFrame) -> DataFrame:
    """The contract's columns: what the mix takes of every document."""
    sizes, shares, found = decided(docs)
    rows = _with_copies(sizes, found)
    return _with_source(rows, shares).select(
        "doc_id", F.col("n_words").alias("size"), "source_size", "target",
        (F.col("copies") * F.col("n_words")).alias("taken"), "source", "copies",
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The documents the mix takes, with all their columns, once per copy."""
    _, _, found = decided(docs)
    names = docs.columns
    keyed = docs.select(
        F.struct(*[F.col(f"`{n}`") for n in names]).alias("_row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"), size().alias("n_words"), F.xxhash64("text").alias("order"),
    )
    rows = _with_copies(keyed, found.filter("copies + more > 0")).filter("copies > 0")
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return rows.select("_row", each.alias("_copy")).select(*[F.col(f"_row.`{n}`").alias(n) for n in names])
