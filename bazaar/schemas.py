"""Types, document schemas and fixed business values."""

from pyspark.sql import types as T

QUANTITY = T.DecimalType(10, 2)
PRICE = T.DecimalType(14, 4)
RATE = T.DecimalType(12, 6)

# Fixed values of the business rules.
LOCAL_ZONE = "Asia/Baku"
CURRENCIES = ("AZN", "USD", "EUR", "TRY")
BASE_CURRENCY = "AZN"
FOREIGN_CURRENCIES = ("USD", "EUR", "TRY")
FUNNEL_STAGES = ("CREATED", "CONFIRMED", "PACKED", "SHIPPED", "DELIVERED")
LOST_STATUSES = ("CANCELLED", "REFUNDED")
FIRST_PLAUSIBLE_DAY = "2020-01-01"
FIRST_VERSION_DAY = "2020-01-01"
BEGINNING_OF_TIME = "1900-01-01"
UNCATEGORIZED = "Uncategorized"
COUNTRY_NAMES = {
    "azerbaijan": "Azerbaijan",
    "AZE": "Azerbaijan",
    "TURKEY": "Turkiye",
    "Türkiye": "Turkiye",
}
NO_COUNTRY = "N/A"


def text_struct(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


# Mixed scalars (number, string or null) are declared as text: JSON numbers arrive as their digits.
ITEM = text_struct("product_id", "quantity", "unit_price")
ORDER_DOC = text_struct("order_id", "customer_id", "channel", "currency", "order_ts", "status", "updated_at").add(
    "items", T.ArrayType(ITEM)
)
FX_DOC = text_struct("date", "quote_currency", "note").add("rates", T.ArrayType(text_struct("currency", "rate_azn")))
EVENT_DOC = text_struct(
    "event_id", "op", "order_id", "old_status", "new_status", "event_ts", "ingested_at", "source"
)
CUSTOMER_CSV = text_struct("customer_id", "full_name", "country", "segment", "signup_date", "updated_at")
PRODUCT_CSV = text_struct("product_id", "product_name", "category", "unit_price", "currency", "updated_at")

# One JSON document per landed response page; records stay raw text.
ORDER_PAGE = T.StructType(
    [
        T.StructField("data", T.ArrayType(T.StringType())),
        T.StructField("next_cursor", T.StringType()),
        T.StructField("page_size", T.IntegerType()),
    ]
)
