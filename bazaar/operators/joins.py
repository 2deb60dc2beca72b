"""Joins that hold up when one key owns a large share of the rows."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SLOT = "_slot"


def with_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that have every key."""
    return rows.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))


def keyed_join(
    fact: DataFrame,
    side: DataFrame,
    keys: list[str],
    how: str = "left",
    residual: Column | None = None,
) -> DataFrame:
    """Equi join of a large fact to a side table, safe for hot keys of the fact.

    AQE can split a hot key only where each join input is an exchange of its own. A side that was just
    grouped by the join key has none, so both sides also join on a hash of the key: same matches, but the
    grouping no longer satisfies the join and Spark plans the exchange. Small sides still become
    broadcasts, by Spark's own size check, never by a hint.
    `residual` may use the columns of both sides (for ranges).
    """
    renamed = {k: f"_side_{k}" for k in keys}
    if how in ("inner", "left_semi"):  # rows that cannot match need no shuffle
        fact = with_keys(fact, keys)
    right = side.withColumnsRenamed(renamed).withColumn(f"_side{_SLOT}", F.xxhash64(*renamed.values()))
    left = fact.withColumn(_SLOT, F.xxhash64(*keys))
    on = F.col(_SLOT) == F.col(f"_side{_SLOT}")
    for key, other in renamed.items():
        on = on & (F.col(key) == F.col(other))
    if residual is not None:
        on = on & residual
    return left.join(right, on, how).drop(_SLOT, f"_side{_SLOT}", *renamed.values())


def flag_known(rows: DataFrame, key: str, reference: DataFrame, reference_key: str, flag: str) -> DataFrame:
    """Left join to the distinct key set of `reference`; `flag` says whether the key is there."""
    known = reference.select(F.col(reference_key).alias(key)).distinct().withColumn(flag, F.lit(True))
    return keyed_join(rows, known, [key]).withColumn(flag, F.coalesce(flag, F.lit(False)))


def semi_join(rows: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    return keyed_join(rows, wanted.select(*keys).distinct(), keys, "left_semi")


def anti_join(rows: DataFrame, keys: list[str], unwanted: DataFrame) -> DataFrame:
    return keyed_join(rows, unwanted.select(*keys).distinct(), keys, "left_anti")


def validity(rows: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """Half-open validity `[start, end)` from each row to the next of its key; the last stays open (null)."""
    return rows.withColumn(end, F.lead(start).over(Window.partitionBy(*by).orderBy(F.col(start).asc_nulls_last())))


def asof_join_daily(
    left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str, values: list[str]
) -> DataFrame:
    """Backward as-of join on days, to a *bounded* right side with one row per key and day.

    Each right row is repeated for the days until the next one, so a left row needs one hash lookup on
    (key, day); days after the last right row take that row, one per key. Both tables have at most one row
    per key and calendar day, which the caller must know to be small: they are broadcast, and the left side
    is not shuffled. `asof_join_large` takes any right side.
    """
    spans = validity(right.select(*by, right_on, *values), by, right_on, "_until")
    found = F.struct(*values)
    filled = spans.filter(F.col("_until").isNotNull()).select(
        *by, F.explode(F.sequence(right_on, F.date_sub("_until", 1))).alias(left_on), found.alias("_then")
    )
    newest = spans.filter(F.col("_until").isNull()).select(*by, F.col(right_on).alias("_since"), found.alias("_newest"))
    latest = F.when(F.col(left_on) >= F.col("_since"), F.col("_newest"))
    return (
        left.join(F.broadcast(filled), [*by, left_on], "left")
        .join(F.broadcast(newest), by, "left")
        .withColumn("_found", F.coalesce("_then", latest))
        .select(*left.columns, *[F.col("_found")[v].alias(v) for v in values])
    )


def asof_join_large(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    left_on: str,
    right_on: str,
    values: list[str],
    bucket_of=lambda moment: F.trunc(moment, "month"),
) -> DataFrame:
    """Backward as-of join for a right side of any size; right rows are unique per key and time.

    Time is cut into buckets (`bucket_of`), so a key's rows spread over its buckets. Within a (key, bucket) both sides are
    sorted together, and a left row takes the last right row before it: each row is looked at once, however many right
    rows a bucket has. What came before a bucket is carried into it, one row per (key, bucket). Left rows without a
    complete key find nothing and skip the sort.
    """
    cell = [*by, "_bucket"]
    picked = F.struct(F.col(right_on).alias("_since"), *values)
    probe = with_keys(left, [*by, left_on]).withColumn("_bucket", bucket_of(F.col(left_on)))
    inside = with_keys(right.select(*by, right_on, *values), [*by, right_on])
    inside = inside.select(*by, bucket_of(F.col(right_on)).alias("_bucket"), F.col(right_on).alias("_at"), picked.alias("_found"))
    last = inside.groupBy(*cell).agg(F.max_by("_found", "_at").alias("_last"))
    cells = probe.select(*cell).distinct()
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        cells.withColumn("_wanted", F.lit(True))
        .join(last, cell, "full")
        .withColumn("_found", F.last("_last", ignorenulls=True).over(before))
        .filter(F.col("_wanted") & F.col("_found").isNotNull())
        .select(*cell, F.col("_found._since").alias("_at"), "_found")
    )
    own = F.struct(*left.columns).alias("_left")
    rows = probe.select(*cell, F.col(left_on).alias("_at"), F.lit(1).alias("_side"), own, F.lit(None).cast(inside.schema["_found"].dataType).alias("_found"))
    for side in (inside, carried):
        none = F.lit(None).cast(rows.schema["_left"].dataType).alias("_left")
        rows = rows.unionByName(side.select(*cell, "_at", F.lit(0).alias("_side"), none, "_found"))
    upto = Window.partitionBy(*cell).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = rows.withColumn("_found", F.last("_found", ignorenulls=True).over(upto)).filter("_side = 1")
    found = met.select(*[F.col("_left")[c].alias(c) for c in left.columns], *[F.col("_found")[v].alias(v) for v in values])
    keyless = left.filter(reduce(Column.__or__, [F.col(c).isNull() for c in [*by, left_on]]))
    return found.unionByName(keyless.select("*", *[F.lit(None).cast(right.schema[v].dataType).alias(v) for v in values]))


def interval_join(
    fact: DataFrame, versions: DataFrame, keys: list[str], at: str, valid_from: str, valid_to: str
) -> DataFrame:
    """Left join to the version valid at `at`; `valid_to` is exclusive and null while open."""
    residual = (F.col(at) >= F.col(valid_from)) & (F.col(valid_to).isNull() | (F.col(at) < F.col(valid_to)))
    return keyed_join(fact, versions, keys, "left", residual)
