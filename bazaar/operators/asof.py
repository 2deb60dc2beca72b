"""As-of joins whose hot cells are split by time."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.operators.joins import keyed_join, with_keys

RANGES = 64  # of a cell, at most; a power of two
PER_RANGE = 1_000_000  # different times that a range should hold, about


def month(moment: Column) -> Column:
    return F.date_trunc("month", moment)


def time_ranges(probes: DataFrame, by: list[str], at: str, per_range: int = PER_RANGE, ranges: int = RANGES, bucket_of=month) -> DataFrame:
    """(by, _bucket, _bounds): where the times of a cell are cut so that each range holds about as many rows.

    Quantiles are estimated by a sketch that is combined on the map side, with an error far below a range; a cell with
    few rows is not cut.
    """
    cuts = [i / ranges for i in range(1, ranges)]
    cells = probes.withColumn("_bucket", bucket_of(F.col(at))).groupBy(*by, "_bucket").agg(
        F.count("*").alias("_n"), F.percentile_approx(at, cuts, 50 * ranges).alias("_cuts")
    )
    power = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.col("_n") / per_range, F.lit(1.0)))))  # so that cuts are evenly spaced
    wanted = F.least(F.lit(ranges), power).cast("int")
    # Every so manieth cut, so that there are `wanted` ranges.
    picked = F.transform(F.sequence(F.lit(1), F.col("_wanted") - 1), lambda i: F.col("_cuts")[F.floor(i * ranges / F.col("_wanted")).cast("int") - 1])
    some = F.when(F.col("_wanted") > 1, F.array_distinct(picked)).otherwise(F.slice("_cuts", 1, 0))
    return cells.withColumn("_wanted", wanted).select(*by, "_bucket", some.alias("_bounds"))


def in_ranges(rows: DataFrame, bounds: DataFrame, by: list[str], at: str, bucket_of=month) -> DataFrame:
    """Adds `_bucket` and `_range`, the number of the cell's bounds at or before the row's time."""
    rows = keyed_join(rows.withColumn("_bucket", bucket_of(F.col(at))), bounds, [*by, "_bucket"])
    below = F.size(F.filter("_bounds", lambda b: b <= F.col(at)))
    return rows.withColumn("_range", F.when(F.col("_bounds").isNull(), 0).otherwise(below)).drop("_bounds")


def asof_join_hot(
    left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str, values: list[str],
    per_range: int = PER_RANGE, bucket_of=month,
) -> DataFrame:
    """Backward as-of join where one key and one month may hold most rows of either side.

    What a left row finds depends on its key and time only, so the different (key, time) are looked up, counted down on the
    map side, and joined back to the rows. A (key, month) cell with many of them is cut into ranges of about equal
    size by estimated quantiles; the last right row before each range is carried into it, so ranges are sorted
    independently. Right rows are unique per key and time. Left rows without a complete key find nothing.
    """
    keys = [*by, left_on]
    probes = with_keys(left, keys).select(*keys).distinct()
    bounds = time_ranges(probes, by, left_on, per_range, bucket_of=bucket_of)
    cell = [*by, "_bucket", "_range"]
    picked = F.struct(F.col(right_on).alias("_since"), *values)
    probe = in_ranges(probes.withColumnRenamed(left_on, "_at"), bounds, by, "_at", bucket_of)
    inside = with_keys(right, [*by, right_on]).select(*by, F.col(right_on).alias("_at"), picked.alias("_found"))
    inside = in_ranges(inside, bounds, by, "_at", bucket_of)
    last = inside.groupBy(*cell).agg(F.max_by("_found", "_at").alias("_last"))
    # One row per range that has left or right rows, in order of time.
    before = Window.partitionBy(*by).orderBy("_bucket", "_range").rowsBetween(Window.unboundedPreceding, -1)
    wanted = probe.select(*cell).distinct().withColumn("_wanted", F.lit(True))
    carried = wanted.join(last, cell, "full").withColumn("_found", F.last("_last", ignorenulls=True).over(before))
    carried = carried.filter("_wanted AND _found IS NOT NULL").select(*cell, F.col("_found._since").alias("_at"), "_found")
    rows = probe.select(*cell, "_at", F.lit(1).alias("_side"), F.lit(None).cast(inside.schema["_found"].dataType).alias("_found"))
    for side in (inside, carried):
        rows = rows.unionByName(side.select(*cell, "_at", F.lit(0).alias("_side"), "_found"))
    upto = Window.partitionBy(*cell).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("_found", F.last("_found", ignorenulls=True).over(upto)).filter("_side = 1 AND _found IS NOT NULL")
    found = found.select(*by, F.col("_at").alias(left_on), "_found")
    joined = keyed_join(left, found, keys)
    return joined.select(*left.columns, *[F.col("_found")[v].alias(v) for v in values])
