"""Silver and quarantine: accepted rows, rejected rows, and the status of record per order."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaar.functions import joined_key
from bazaar.operators.dedup import latest_by
from bazaar.operators.joins import keyed_join
from bazaar.operators.rules import accepted, first_match, rejected
from bazaar.plans.staging import CUSTOMER, ORDER_LINE, PRODUCT, STATUS_EVENT


def order_lines(staged: DataFrame) -> DataFrame:
    return accepted(staged, ORDER_LINE)


def order_lines_rejected(staged: DataFrame) -> DataFrame:
    return rejected(staged, "silver_order_lines", joined_key("order_id", "line_number", "reason_code"))


def customers(staged: DataFrame) -> DataFrame:
    return accepted(staged, CUSTOMER)


def customers_rejected(staged: DataFrame) -> DataFrame:
    return rejected(staged, "silver_customers", joined_key("customer_id", "snapshot_date", "reason_code"))


def products(staged: DataFrame) -> DataFrame:
    return accepted(staged, PRODUCT)


def products_rejected(staged: DataFrame) -> DataFrame:
    return rejected(staged, "silver_products", joined_key("product_id", "reason_code"))


def status_history(staged: DataFrame) -> DataFrame:
    return accepted(staged, STATUS_EVENT)


def status_history_rejected(staged: DataFrame) -> DataFrame:
    event = F.coalesce("event_id", F.lit("no_id"))
    order = F.coalesce("order_id", F.lit("no_order"))
    return rejected(staged, "silver_order_events", joined_key(event, order, "reason_code"))


def status_reconciliation(staged_lines: DataFrame, history: DataFrame) -> DataFrame:
    """Order status by events against the status of the latest document; events win where they say something.

    The document side reads staging, so orders whose every line was rejected are there too.
    """
    by_document = latest_by(
        staged_lines.select("order_id", "updated_at", F.col("status").alias("api_status")),
        ["order_id"], ["updated_at"], ["api_status"],
    ).drop("updated_at")
    by_event = latest_by(
        history.select("order_id", "event_ts", "event_id", "new_status", "op"),
        ["order_id"], ["event_ts"], ["event_id"],
    ).select(
        "order_id",
        F.col("new_status").alias("event_status"),
        F.col("op").alias("latest_event_op"),
        F.lit(True).alias("_has_event"),
    )
    both = keyed_join(by_document, by_event, ["order_id"])
    kind = first_match(
        [
            ("tombstone_erasure", F.col("latest_event_op") == "d"),
            ("no_events_for_order", F.col("_has_event").isNull()),
            ("status_mismatch", ~F.col("api_status").eqNullSafe(F.col("event_status"))),
            ("match", F.lit(True)),
        ]
    )
    return both.select(
        "order_id",
        "api_status",
        "event_status",
        F.coalesce("event_status", "api_status").alias("final_status"),
        "latest_event_op",
        kind.alias("reconciliation_status"),
    )
