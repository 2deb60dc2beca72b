"""Gold: dimensions and facts."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.functions import joined_key, local_date
from bazaar.operators.dedup import latest_by
from bazaar.operators.joins import asof_join_daily, interval_join, keyed_join
from bazaar.operators.scd2 import merge_snapshot, scd2
from bazaar.schemas import (
    BASE_CURRENCY,
    CURRENCIES,
    FIRST_VERSION_DAY,
    FOREIGN_CURRENCIES,
    FX_DOC,
    LOST_STATUSES,
    RATE,
)

CUSTOMER_ATTRIBUTES = ["full_name", "country", "segment", "signup_date"]


def dim_customer(customers: DataFrame, only_bounds: bool = False) -> DataFrame:
    return customer_versions(scd2(customers, "customer_id", CUSTOMER_ATTRIBUTES, "snapshot_date", FIRST_VERSION_DAY, only_bounds))


def customer_versions(versions: DataFrame) -> DataFrame:
    """The dimension's columns over versions of customers."""
    return versions.select(
        joined_key("customer_id", "valid_from").alias("customer_key"),
        "customer_id",
        *CUSTOMER_ATTRIBUTES,
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def merge_customers(dimension: DataFrame, series: list[str], snapshot: DataFrame, day: str, present: bool = True) -> tuple[DataFrame, DataFrame]:
    """One snapshot into the dimension of a series: (customers that change, their new rows); see `merge_snapshot`."""
    changed, fresh = merge_snapshot(
        dimension, series, snapshot, day, "customer_id", CUSTOMER_ATTRIBUTES, "snapshot_date", FIRST_VERSION_DAY, present
    )
    return changed, customer_versions(fresh)


def dim_date(bounds: DataFrame) -> DataFrame:
    """Calendar of the days from `first_day` to `last_day` of a one-row frame."""
    day = F.col("date_day")
    iso_day = F.weekday(day) + 1
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("date_day")).select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        "date_day",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.day(day).alias("day"),
        F.rpad(F.date_format(day, "MMMM"), 9, " ").alias("month_name"),
        F.quarter(day).alias("quarter"),
        iso_day.alias("day_of_week"),
        iso_day.isin(6, 7).alias("is_weekend"),
    )


def day_bounds(*days: DataFrame) -> DataFrame:
    """One row for `dim_date`: the first and last day of one-column frames of days."""
    every = reduce(DataFrame.unionAll, [d.toDF("day") for d in days])
    return every.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day")).filter("first_day IS NOT NULL")


def calendar(spark, first_day: str, last_day: str) -> DataFrame:
    one_row = spark.range(1).select(
        F.lit(first_day).cast("date").alias("first_day"), F.lit(last_day).cast("date").alias("last_day")
    )
    return dim_date(one_row)


def dim_product(staged_products: DataFrame) -> DataFrame:
    """Every product a line may refer to; bad catalogue attributes are nulled and flagged, the row stays."""
    reason = F.col("reason_code")
    left_out = reason.eqNullSafe("duplicate_product") | reason.eqNullSafe("missing_product_id")
    return staged_products.filter(~left_out).select(
        "product_id",
        "product_name",
        "category",
        F.when(F.col("unit_price") >= 0, F.col("unit_price")).alias("list_price"),
        F.when(F.col("currency").isin(*CURRENCIES), F.col("currency")).alias("list_currency"),
        reason.isNotNull().alias("has_catalog_issue"),
    )


def fx_rates(bronze_fx: DataFrame) -> DataFrame:
    """One rate per foreign currency and day, the latest received.

    At most (foreign currencies x days) rows, which is what allows the broadcast in `with_rate`.
    """
    rates = bronze_fx.select(
        F.col("rate_date").cast("date").alias("rate_date"),
        F.explode(F.from_json("payload", FX_DOC)["rates"]).alias("rate"),
        "_ingested_at",
    ).select("rate_date", "rate.currency", F.col("rate.rate_azn").cast(RATE).alias("rate_azn"), "_ingested_at")
    foreign = rates.filter(F.col("currency").isin(*FOREIGN_CURRENCIES))
    return latest_by(foreign, ["currency", "rate_date"], ["_ingested_at"], ["rate_azn"]).drop("_ingested_at")


def with_rate(rows: DataFrame, rates: DataFrame, day: str) -> DataFrame:
    """Adds `rate_azn`: 1 for the base currency, else the last published rate at or before `day`."""
    joined = asof_join_daily(rows, rates, ["currency"], day, "rate_date", ["rate_azn"])
    base = F.when(F.col("currency") == BASE_CURRENCY, F.lit(1).cast(RATE)).otherwise(F.col("rate_azn"))
    return joined.withColumn("rate_azn", base)


def _date_keys(dates: DataFrame, day: str, key: str) -> DataFrame:
    return dates.select(F.col("date_day").alias(day), F.col("date_key").alias(key))


def _with_date_key(rows: DataFrame, dates: DataFrame, day: str, key: str) -> DataFrame:
    # One row per calendar day. No hint: the calendar follows the data, and one stray day in the far future makes it long.
    return rows.join(_date_keys(dates, day, key), day, "left")


def is_recognized(status: Column) -> Column:
    return ~status.isin(*LOST_STATUSES)


def fct_order_lines(
    lines: DataFrame, rates: DataFrame, reconciliation: DataFrame, dates: DataFrame, customers: DataFrame
) -> DataFrame:
    """Order-line fact: amounts in the base currency, customer version of the day, final status."""
    rows = lines.select(
        "order_id", "line_number", "customer_id", "product_id", "status", "currency", "quantity", "unit_price",
        local_date(F.col("order_ts")).alias("order_date_baku"),
    )
    rows = with_rate(rows, rates, "order_date_baku")
    rows = _with_date_key(rows, dates, "order_date_baku", "order_date_key")
    rows = keyed_join(rows, reconciliation.select("order_id", "final_status"), ["order_id"])
    versions = customers.select("customer_id", "customer_key", "valid_from", "valid_to")
    rows = interval_join(rows, versions, ["customer_id"], "order_date_baku", "valid_from", "valid_to")
    gross = F.col("quantity") * F.col("unit_price")
    status = F.coalesce("final_status", "status")
    return rows.select(
        "order_id",
        "line_number",
        "customer_key",
        "product_id",
        "order_date_key",
        "order_date_baku",
        "quantity",
        "unit_price",
        "currency",
        "rate_azn",
        gross.alias("gross_amount"),
        (gross * F.col("rate_azn")).alias("gross_amount_azn"),
        status.alias("final_status"),
        is_recognized(status).alias("is_recognized"),
    )


def fct_order_status_events(history: DataFrame, dates: DataFrame) -> DataFrame:
    rows = history.withColumn("event_date_baku", local_date(F.col("event_ts")))
    return _with_date_key(rows, dates, "event_date_baku", "event_date_key").select(
        "event_id", "order_id", "op", "old_status", "new_status", "event_ts", "event_date_key", "event_date_baku"
    )
