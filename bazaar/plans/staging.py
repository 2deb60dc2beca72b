"""Staging: parsed bronze rows, each with a nullable `reason_code`."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar import functions as fn
from bazaar.operators.dedup import drop_copies, mark_latest
from bazaar.operators.joins import flag_known
from bazaar.operators.rules import first_match
from bazaar.schemas import CURRENCIES, EVENT_DOC, FIRST_PLAUSIBLE_DAY, ORDER_DOC, QUANTITY, UNCATEGORIZED

RECORD = "_record_id"

ORDER_LINE = [
    "order_id", "line_number", "customer_id", "product_id", "status", "channel", "currency",
    "order_ts", "updated_at", "quantity", "unit_price",
]
CUSTOMER = ["customer_id", "full_name", "country", "segment", "signup_date", "updated_at", "snapshot_date"]
PRODUCT = ["product_id", "product_name", "category", "unit_price", "currency", "updated_at"]
STATUS_EVENT = ["event_id", "order_id", "op", "old_status", "new_status", "event_ts", "source"]


def _unsupported(currency: str) -> Column:
    # A null currency is neither in nor out of the list, so this rule does not fire for it.
    return ~F.col(currency).isin(*CURRENCIES)


def orders(bronze_orders: DataFrame) -> DataFrame:
    """Parsed order documents; `is_latest` is false on every older version or copy of an order."""
    doc = bronze_orders.select(RECORD, F.from_json("payload", ORDER_DOC).alias("doc")).select(RECORD, "doc.*")
    parsed = doc.select(
        RECORD,
        "order_id",
        "customer_id",
        "status",
        "channel",
        fn.currency(F.col("currency")).alias("currency"),
        fn.mixed_timestamp(F.col("order_ts")).alias("order_ts"),
        F.col("updated_at").cast("timestamp").alias("updated_at"),
        "items",
    )
    # The promoted columns find the latest version without opening the documents a second time.
    index = bronze_orders.select(
        RECORD, F.col("_order_id").alias("order_id"), F.col("_updated_at").alias("updated_at")
    )
    return mark_latest(parsed, ["order_id"], ["updated_at"], RECORD, "is_latest", index)


def exploded_lines(parsed_orders: DataFrame) -> DataFrame:
    """One row per item, numbered from 1; orders without items give none.

    The outer form, filtered: the inner one makes Spark test `items` below the parse, parsing twice.
    """
    items = parsed_orders.select("*", F.posexplode_outer("items").alias("_pos", "_item"))
    return items.filter(F.col("_pos").isNotNull()).select(
        *[c for c in parsed_orders.columns if c != "items"],
        (F.col("_pos") + 1).cast("bigint").alias("line_number"),
        F.col("_item.product_id").alias("product_id"),
        F.col("_item.quantity").cast(QUANTITY).alias("quantity"),
        fn.price(F.col("_item.unit_price")).alias("unit_price"),
    )


def order_lines(bronze_orders: DataFrame, bronze_customers: DataFrame, bronze_products: DataFrame) -> DataFrame:
    """Order lines with their verdict. References are checked against raw bronze, rejects included."""
    documents = flag_known(orders(bronze_orders), "customer_id", bronze_customers, "customer_id", "_known_customer")  # one customer a document
    lines = flag_known(exploded_lines(documents), "product_id", bronze_products, "product_id", "_known_product")
    verdict = first_match(
        [
            ("duplicate_order", ~F.col("is_latest")),
            ("missing_customer_id", fn.is_blank(F.col("customer_id"))),
            ("unsupported_currency", _unsupported("currency")),
            ("implausible_order_ts", F.col("order_ts") < F.lit(FIRST_PLAUSIBLE_DAY).cast("timestamp")),
            ("missing_unit_price", F.col("unit_price").isNull()),
            ("negative_unit_price", F.col("unit_price") < 0),
            ("invalid_quantity", F.col("quantity") <= 0),
            ("unknown_customer", ~F.col("_known_customer")),
            ("unknown_product", ~F.col("_known_product")),
        ]
    )
    return lines.select(*ORDER_LINE, verdict.alias("reason_code"))


def customers(bronze_customers: DataFrame) -> DataFrame:
    parsed = bronze_customers.select(
        RECORD,
        "customer_id",
        "full_name",
        fn.country(F.col("country")).alias("country"),
        "segment",
        F.col("signup_date").cast("date").alias("signup_date"),
        F.col("updated_at").cast("timestamp").alias("updated_at"),
        F.col("snapshot_date").cast("date").alias("snapshot_date"),
    )
    marked = mark_latest(parsed, ["customer_id", "snapshot_date"], ["updated_at"], RECORD, "is_latest")
    verdict = first_match(
        [
            ("missing_customer_id", fn.is_blank(F.col("customer_id"))),
            ("duplicate_customer_snapshot", ~F.col("is_latest")),
        ]
    )
    return marked.select(*CUSTOMER, verdict.alias("reason_code"))


def products(bronze_products: DataFrame) -> DataFrame:
    parsed = bronze_products.select(
        RECORD,
        "product_id",
        "product_name",
        F.coalesce(F.nullif(F.trim("category"), F.lit("")), F.lit(UNCATEGORIZED)).alias("category"),
        fn.price(F.col("unit_price")).alias("unit_price"),
        fn.currency(F.col("currency")).alias("currency"),
        F.col("updated_at").cast("timestamp").alias("updated_at"),
    )
    marked = mark_latest(parsed, ["product_id"], ["updated_at"], RECORD, "is_latest")
    verdict = first_match(
        [
            ("missing_product_id", fn.is_blank(F.col("product_id"))),
            ("duplicate_product", ~F.col("is_latest")),
            ("unsupported_currency", _unsupported("currency")),
            ("missing_unit_price", F.col("unit_price").isNull()),
            ("negative_unit_price", F.col("unit_price") < 0),
        ]
    )
    return marked.select(*PRODUCT, verdict.alias("reason_code"))


def parsed_events(bronze_events: DataFrame) -> DataFrame:
    """Status events from their documents, repeats dropped (arrival time is not part of an event)."""
    doc = bronze_events.select(F.from_json("payload", EVENT_DOC).alias("doc")).select("doc.*")
    return drop_copies(doc.withColumn("event_ts", F.col("event_ts").cast("timestamp")), STATUS_EVENT)


def order_ids(bronze_orders: DataFrame) -> DataFrame:
    """Ids of every order ever received."""
    return bronze_orders.select(F.col("_order_id").alias("order_id"))


def order_events(bronze_events: DataFrame, bronze_orders: DataFrame) -> DataFrame:
    events = flag_known(parsed_events(bronze_events), "order_id", order_ids(bronze_orders), "order_id", "_known_order")
    verdict = first_match(
        [
            ("missing_event_id", fn.is_blank(F.col("event_id"))),
            ("unknown_order", ~F.col("_known_order")),
        ]
    )
    return events.select(*STATUS_EVENT, verdict.alias("reason_code"))
