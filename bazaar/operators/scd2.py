"""Slowly changing dimension, type 2, from a series of full snapshots."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def scd2(
    snapshots: DataFrame, key: str, attrs: list[str], snap: str, first_from: str, only_bounds: bool = False,
    series: list[str] | None = None,
) -> DataFrame:
    """Versions `[valid_from, valid_to)` of each key; one row per (key, snapshot) is expected.

    A version starts where the key is new, an attribute differs (null-safe), or a snapshot was skipped; it
    ends at the snapshot after its last one. `only_bounds` compares just the first and the last snapshot.
    Windows run per key over one row per snapshot, so a group is at most as long as the snapshot series.
    `series` names the days of all snapshots, where `snapshots` has some of the keys only.
    """
    dates = snapshots.select(snap).filter(F.col(snap).isNotNull())
    if series is not None:
        dates = snapshots.sparkSession.createDataFrame([(d,) for d in series], f"{snap} string").select(F.col(snap).cast("date"))
    if only_bounds:
        dates = dates.agg(F.array(F.min(snap), F.max(snap)).alias("bounds")).select(F.explode("bounds").alias(snap))
    in_order = Window.orderBy(snap)  # over distinct days: bounded by the calendar, hence also the broadcast below
    days = dates.distinct().select(
        snap,
        F.lag(snap).over(in_order).alias("_day_before"),
        F.lead(snap).over(in_order).alias("_day_after"),
    )
    history = Window.partitionBy(key).orderBy(snap)
    state = F.struct(*attrs)
    continues = F.lag(snap).over(history).eqNullSafe(F.col("_day_before")) & F.lag(state).over(history).eqNullSafe(state)
    first_day = F.col("_day_before").isNull()
    versioned = (
        snapshots.select(key, *attrs, snap)
        .join(F.broadcast(days), snap)
        .withColumn("_starts", (first_day | ~continues).cast("int"))
        .withColumn("_version", F.sum("_starts").over(history))
    )
    valid_from = F.when(first_day, F.lit(first_from).cast("date")).otherwise(F.col(snap)).alias("valid_from")
    opening = F.min_by(F.struct(*attrs, valid_from), snap)
    return (
        versioned.groupBy(key, "_version")
        .agg(opening.alias("_o"), F.max_by("_day_after", snap).alias("valid_to"))
        .select(key, "_o.*", "valid_to", F.col("valid_to").isNull().alias("is_current"))
    )


def _days(series: list[str]) -> Column:
    return F.array(*[F.lit(d).cast("date") for d in series]).cast("array<date>")


def merged_series(series: list[str], day: str, present: bool = True) -> list[str]:
    """The days of all snapshots with one more, or one less."""
    return sorted({*series, day} if present else set(series) - {day})


def merge_snapshot(
    versions: DataFrame, series: list[str], snapshot: DataFrame, day: str, key: str, attrs: list[str], snap: str, first_from: str,
    present: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Bring one snapshot into the versions that `scd2` makes of a series: (keys that change, their new versions).

    The day may be the newest, lie between two known ones (versions that span it are split), be known already (its
    snapshot is replaced) or go (`present=False`). Between two snapshots a version says what a key is, so a key whose row
    of the day is what its versions say of that day does not change; only the others are taken apart into days
    and put together again. Reads the versions and one snapshot, whatever the length of the series. A key has one row in the
    snapshot; days lie on or after `first_from`; keys are not null.
    """
    after, on = merged_series(series, day, present), F.lit(day).cast("date")
    covers = lambda d: (F.col("valid_from") <= d) & (F.col("valid_to").isNull() | (F.col("valid_to") > d))
    rows = versions.select(key, *attrs, "valid_from", "valid_to")
    if present:
        was = rows.filter(covers(on)).select(key, F.struct(*attrs).alias("_was"), F.lit(1).alias("_had"))
        now = snapshot.select(key, F.struct(*attrs).alias("_now"), F.lit(1).alias("_has"))
        both = was.join(now, key, "full")
        same = F.col("_had").eqNullSafe(F.col("_has")) & F.col("_was").eqNullSafe(F.col("_now"))
        changed = both.filter(~same).select(key)
    else:  # versions that begin or end on the day, or become those of the first day
        first = [d for d in after if not series or d > series[0]][:1] if series and series[0] == day else []
        begins = F.col("valid_from").isin([F.lit(d).cast("date") for d in [day, *first, *([first_from] if first else [])]])
        changed = rows.filter(begins | (F.col("valid_to") == on)).select(key).distinct()
    known = [d for d in series if d != day]
    mine = rows.join(changed, key, "left_semi").withColumn("_days", F.filter(_days(known), covers))
    parts = mine.select(key, *attrs, F.explode("_days").alias(snap))
    if present:
        parts = parts.unionByName(snapshot.join(changed, key, "left_semi").select(key, *attrs, on.alias(snap)))
    return changed, scd2(parts, key, attrs, snap, first_from, series=after)
