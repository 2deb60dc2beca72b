"""Replace and upsert as set operations, for tables without MERGE."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.operators.joins import anti_join
from bazaar.schemas import BEGINNING_OF_TIME


def upsert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Delete + insert: target rows whose key is in the batch go, every batch row comes, repeats included."""
    return anti_join(target, keys, batch).unionByName(batch)


def in_range(column: Column, low, high) -> Column:
    """Half-open `[low, high)`."""
    return (column >= low) & (column < high)


def replace_range(target: DataFrame, batch: DataFrame, column: Column, low, high) -> DataFrame:
    """Target rows outside `[low, high)` plus the batch; a range with no incoming row is emptied.

    A null in `column` is outside every range, so such rows stay.
    """
    outside = F.coalesce(~in_range(column, low, high), F.lit(True))
    return target.filter(outside).unionByName(batch)


def high_watermark(target: DataFrame, moment: Column) -> Column:
    """Largest `moment` of the target as a scalar subquery; an empty target starts at the beginning of time."""
    beginning = F.lit(BEGINNING_OF_TIME).cast("timestamp")
    return target.agg(F.coalesce(F.max(moment), beginning).alias("high")).scalar()
