"""Chat formatting with cumulative-snapshot collapse.

Logs often hold one conversation many times, each time with a few more turns. Every turn gets the hash of the
conversation up to it: a sum of hashes of (rank, role, text), which can be added up piece by piece. A conversation whose
last hash is found at an inner turn of another is a prefix of it; an anti-join keeps the maximal ones, of which equal ones
leave the smallest conv_id. Only then are texts rendered.

Turns are ranked and summed in two steps, within parts of PART turn numbers and then over the parts, so a conversation
that owns a large share of all turns is many small windows. It also comes back as parts, one row for each; all others
are one row.

Defined cases: turns are ordered by turn (null last), then role and text; null role or text count as empty text; turns
without conv_id belong to no conversation and are left out; repeated turns count as turns; other columns are not read;
an empty table gives none.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm import common
from bazaar.operators.joins import keyed_join

PART = 4_096
MARKS = ("<|", "|>")


def escaped(text: Column) -> Column:
    """Text that cannot be mistaken for a role's mark."""
    return F.replace(F.replace(text, F.lit(MARKS[0]), F.lit("< |")), F.lit(MARKS[1]), F.lit("| >"))


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, part, rank, role, text, and `prefix`: two hashes of the conversation up to the turn."""
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"),
        F.coalesce(F.col("turn").cast("long"), F.lit((1 << 63) - 1)).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.withColumn("part", F.floor(F.col("turn") / PART))
    inside = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text")
    rows = rows.withColumn("local", F.row_number().over(inside))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    offsets = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = keyed_join(rows, offsets, ["conv_id", "part"], "inner").withColumn("rank", F.col("local") + F.col("offset"))
    hashes = [F.xxhash64(F.lit(n), "rank", "role", "text").cast("decimal(20,0)").alias(n) for n in "hg"]
    ranked = common.saved(ranked.select("conv_id", "part", "rank", "role", "text", *hashes), "turns")
    sums = ranked.groupBy("conv_id", "part").agg(*[F.sum(c).alias(c) for c in "hg"])
    zero = F.lit(0).cast("decimal(30,0)")
    sums = sums.select("conv_id", "part", *[F.coalesce(F.sum(c).over(before), zero).cast("decimal(38,0)").alias(f"{c}0") for c in "hg"])
    upto = Window.partitionBy("conv_id", "part").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    summed = keyed_join(ranked, sums, ["conv_id", "part"], "inner")
    total = [(F.sum(c).over(upto) + F.col(f"{c}0")).cast("string") for c in "hg"]
    return summed.select("conv_id", "part", "rank", "role", "text", F.concat_ws(" ", "rank", *total).alias("prefix"))


def maximal(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_snapshots) of conversations that no other one continues.

    n_snapshots counts the conversations with the same turns, itself included.
    """
    return _maximal(common.saved(turns(conversations), "prefixes"))


def _maximal(rows: DataFrame) -> DataFrame:
    rows = rows.select("conv_id", "rank", "prefix")
    n = rows.groupBy("conv_id").agg(F.max("rank").alias("n_turns"))
    ends = keyed_join(rows, n, ["conv_id"], "inner")
    last = ends.filter("rank = n_turns").groupBy("prefix", "n_turns").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_snapshots")
    )
    inner = ends.filter("rank < n_turns").select("prefix").distinct()
    return keyed_join(last, inner, ["prefix"], "left_anti").select("conv_id", "n_turns", "n_snapshots")


def rendered(conversations: DataFrame) -> DataFrame:
    """Maximal conversations as chat text: conv_id, part, n_turns, n_snapshots, text."""
    rows = common.saved(turns(conversations), "prefixes")
    stay = _maximal(rows)
    body = F.concat(F.lit(MARKS[0]), escaped(F.col("role")), F.lit(MARKS[1] + "\n"), escaped(F.col("text")), F.lit("\n"))
    kept = keyed_join(rows.select("conv_id", "part", "rank", body.alias("body")), stay, ["conv_id"], "inner")
    parts = kept.groupBy("conv_id", "part", "n_turns", "n_snapshots").agg(F.array_sort(F.collect_list(F.struct("rank", "body"))).alias("b"))
    first = F.dense_rank().over(Window.partitionBy("conv_id").orderBy("part")) - 1
    return parts.select(
        "conv_id", first.cast("long").alias("part"), "n_turns", "n_snapshots", F.array_join("b.body", "").alias("text")
    )
