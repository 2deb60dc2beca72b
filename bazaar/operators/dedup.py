"""Latest row per key and duplicate marking, without putting one key's rows into one task."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def recency(newest_by: list[str], *last: str) -> Column:
    """Struct whose maximum is the newest row: descending with nulls first, then the tie-breaking columns."""
    parts = []
    for i, name in enumerate(newest_by):
        parts += [F.col(name).isNull().alias(f"n{i}"), F.col(name).alias(f"v{i}")]
    return F.struct(*parts, *[F.col(name).alias(f"t{i}") for i, name in enumerate(last)])


def latest_by(rows: DataFrame, keys: list[str], newest_by: list[str], ties: list[str] | None = None) -> DataFrame:
    """One whole row per key: the newest. An aggregate, so each map task sends at most one row per key."""
    ties = ties or []
    rest = [c for c in rows.columns if c not in keys]
    top = F.max_by(F.struct(*rest), recency(newest_by, *ties)).alias("_top")
    return rows.groupBy(*keys).agg(top).select(*keys, "_top.*").select(*rows.columns)


def mark_latest(
    rows: DataFrame,
    keys: list[str],
    newest_by: list[str],
    record_id: str,
    flag: str,
    index: DataFrame | None = None,
) -> DataFrame:
    """Keep every row and flag the newest of each key; equal times are decided by `record_id`.

    The winners are found by a narrow aggregate and joined back on `record_id`, which is unique, rather
    than on the key. A key that holds a third of all rows therefore never meets in one task. `index` may
    give the key, time and id columns from a cheaper place than the rows themselves.
    """
    winners = (
        (rows if index is None else index)
        .groupBy(*keys)
        .agg(F.max_by(record_id, recency(newest_by, record_id)).alias("_winner"))
        .select("_winner")
    )
    return (
        rows.join(winners, F.col(record_id) == F.col("_winner"), "left")
        .withColumn(flag, F.col("_winner").isNotNull())
        .drop("_winner")
    )


def drop_copies(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct rows over the given columns; copies collapse on the map side before the shuffle."""
    return rows.select(*(columns or rows.columns)).distinct()
