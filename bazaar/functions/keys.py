"""Surrogate keys and row documents."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_key(*parts: Column | str) -> Column:
    """md5 of the parts joined by ':'; null when any part is null (concat, not concat_ws)."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    pieces = [cols[0]]
    for col in cols[1:]:
        pieces += [F.lit(":"), col.cast("string")]
    return F.md5(F.concat(*pieces))


def json_row(columns: list[str]) -> Column:
    """The row as a JSON document that keeps its null fields."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
