"""Column-to-column parsers. All are built-in expressions, so they stay inside whole-stage codegen."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from bazaar.schemas import COUNTRY_NAMES, LOCAL_ZONE, NO_COUNTRY, PRICE

# Fixed patterns of the raw order time.
EPOCH_MILLIS = r"^\d+$"
DOTTED_LOCAL = r"^\d{2}\.\d{2}\.\d{4} \d{2}:\d{2}:\d{2}$"
DOTTED_LOCAL_FORMAT = "dd.MM.yyyy HH:mm:ss"


def is_blank(text: Column) -> Column:
    return text.isNull() | (text == "")


def currency(text: Column) -> Column:
    return F.upper(F.trim(text))


def country(text: Column) -> Column:
    """Trimmed country name with known spellings mapped (case matters) and the 'no answer' mark as null."""
    trimmed = F.trim(text)
    known = reduce(
        lambda chain, pair: chain.when(trimmed == pair[0], F.lit(pair[1])),
        COUNTRY_NAMES.items(),
        F.when(trimmed == NO_COUNTRY, F.lit(None).cast("string")),
    )
    return known.otherwise(trimmed)


def price(text: Column, as_type: DecimalType = PRICE) -> Column:
    """Decimal from a number text with optional thousands commas; empty text is null, other text is an error."""
    return F.nullif(F.replace(text, F.lit(","), F.lit("")), F.lit("")).cast(as_type)


def mixed_timestamp(text: Column, zone: str = LOCAL_ZONE) -> Column:
    """Instant from epoch milliseconds, a dotted local time, or ISO 8601 with Z or an offset."""
    dotted = F.try_to_timestamp(text, F.lit(DOTTED_LOCAL_FORMAT))
    return (
        F.when(text.rlike(EPOCH_MILLIS), F.timestamp_millis(text.try_cast("bigint")))
        .when(text.rlike(DOTTED_LOCAL), F.to_utc_timestamp(dotted, zone))
        .otherwise(text.cast("timestamp"))
    )


def timestamp_format(text: Column) -> Column:
    """Name of the format a raw time is written in; for profiling."""
    return (
        F.when(text.rlike(EPOCH_MILLIS), "epoch_ms")
        .when(text.rlike(DOTTED_LOCAL), "dotted_local")
        .when(text.endswith("Z"), "iso_utc")
        .when(text.isNotNull(), "iso_offset")
    )


def local_date(instant: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(instant, zone))
