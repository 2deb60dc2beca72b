"""Column functions: text cleaning, mixed-format parsing, keys and calendar parts."""

from bazaar.functions.keys import joined_key, json_row
from bazaar.functions.parsing import country, currency, is_blank, local_date, mixed_timestamp, price, timestamp_format

__all__ = [
    "country",
    "currency",
    "is_blank",
    "joined_key",
    "json_row",
    "local_date",
    "mixed_timestamp",
    "price",
    "timestamp_format",
]
