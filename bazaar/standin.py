"""Bronze inputs made from star-schema test tables.

Each function turns a table into raw rows with the shapes and defects of the real feeds, by expressions on
the row itself: every table row gives a document, and the key arithmetic only decides which defect it has.
No rows are grouped to build a document, so a hot key makes many documents, not one huge one.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER_SHIFT_DAYS = 9500  # moves the 1995-2001 order days to 2021-2027, past the last summer-time change
OLD_ORDER_DAY = 18062  # 2019-06-15 as days since 1970, before the first plausible day
FIRST_RATE_DAY = "2021-02-01"
SNAPSHOT_DAYS = ("2023-06-01", "2024-06-01", "2025-06-01")
LANDED_AT = "2026-08-25 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _located(rows: DataFrame) -> DataFrame:
    """Adds the row's place in its file, which identifies it whatever it holds."""
    return rows.select("*", F.concat_ws(":", "_metadata.file_name", "_metadata.row_index").alias("_record_id"))


def _twice_if(rows: DataFrame, condition: Column) -> DataFrame:
    """Repeats the rows that meet the condition; `_copy` is 0 and 1, and part of the record id."""
    copies = F.when(condition, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_copy", F.explode(copies)).withColumn(
        "_record_id", F.concat_ws(":", "_record_id", "_copy")
    )


def _audit(rows: DataFrame, source: str, load_id: Column) -> DataFrame:
    return rows.select(
        "*",
        F.lit(source).alias("_source"),
        F.lit("standin").alias("_batch_id"),
        load_id.alias("_load_id"),
        F.lit(LANDED_AT).cast("timestamp").alias("_ingested_at"),
    )


def _json_text(value: Column) -> Column:
    return F.coalesce(F.concat(F.lit('"'), value, F.lit('"')), F.lit("null"))


def _field(name: str, json: Column) -> list[Column]:
    return [F.lit(f'"{name}":'), json]


def _object(**fields: Column) -> Column:
    """JSON object text from field texts; numbers stay unquoted, which to_json on one column cannot mix."""
    parts = [F.lit("{")]
    for i, (name, json) in enumerate(fields.items()):
        parts += [F.lit("," if i else ""), *_field(name, json)]
    return F.concat(*parts, F.lit("}"))


def _day_number(moment: str) -> Column:
    return F.unix_date(F.col(moment).cast("date"))


def raw_orders(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Order fields before they become documents: one per line item, partly broken.

    The order id is (order key, line number), which repeats in the data: natural duplicate versions.
    `spread` deals the rows out while they are still narrow, before text is made of them: the join shuffles both sides, however
    small orders are, and that one exchange makes even partitions and splits hot keys.
    """
    lines = _located(table(spark, sf_dir, "lineitem"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    rows = lines.join(orders.hint("merge") if spread else orders, F.col("l_orderkey") == F.col("o_orderkey"))
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    day = F.when(part % 113 == 3, F.lit(OLD_ORDER_DAY)).otherwise(_day_number("o_orderdate") + ORDER_SHIFT_DAYS)
    second_of_day = (part * 61 + line * 7) % 86400
    ordered = day.cast("bigint") * 86400 + second_of_day
    rows = rows.select(
        "_record_id",
        F.concat(F.lit("O"), "l_orderkey", F.lit("-"), "l_linenumber").alias("order_id"),
        F.when(part % 101 == 9, F.lit(None))
        .when(part % 89 == 5, F.lit(""))
        .when(part % 97 == 7, F.concat(F.lit("X"), "o_custkey"))
        .otherwise(F.concat(F.lit("C"), "o_custkey"))
        .alias("customer_id"),
        F.element_at(F.array(F.lit("web"), F.lit("mobile"), F.lit("pos")), (line % 3 + 1).cast("int")).alias("channel"),
        F.when((supp % 10 == 9) & (part % 50 == 0), F.lit("AZM"))
        .when((supp % 10 == 9) & (part % 50 == 1), F.lit(None))
        .otherwise(
            F.element_at(
                F.array(*[F.lit(c) for c in ("AZN", "AZN", "azn", " usd ", "USD", "EUR", "eur", "try", "TRY", "AZN")]),
                (supp % 10 + 1).cast("int"),
            )
        )
        .alias("currency"),
        F.timestamp_seconds(ordered).alias("ordered_at"),
        F.timestamp_micros(
            (ordered + 86400) * 1000000 + (supp % 1000) * 1000 + F.col("l_quantity").cast("bigint")
        ).alias("updated"),
        (line % 4).alias("time_format"),
        F.when((F.col("o_orderstatus") == "F") & (line == 7), F.lit("REFUNDED"))
        .when(F.col("o_orderstatus") == "F", F.lit("DELIVERED"))
        .when(F.col("o_orderstatus") == "O", F.lit("SHIPPED"))
        .when(supp % 2 == 0, F.lit("CANCELLED"))
        .otherwise(F.lit("PACKED"))
        .alias("status"),
        F.when(part % 211 == 0, F.concat(F.lit("Z"), "l_partkey"))
        .otherwise(F.concat(F.lit("P"), "l_partkey"))
        .alias("product_id"),
        F.concat(F.lit("P"), "l_suppkey").alias("second_product_id"),
        F.when(part % 301 == 7, F.lit(0))
        .when(part % 301 == 8, F.lit(-1))
        .otherwise(F.col("l_quantity").cast("int"))
        .alias("quantity"),
        F.when(part % 307 == 11, F.lit("null"))
        .when(part % 307 == 12, F.lit('""'))
        .when(part % 307 == 13, F.concat(F.lit("-"), F.col("l_extendedprice").cast("string")))
        .when(part % 5 == 0, _json_text(F.format_number("l_extendedprice", 2)))
        .when(part % 5 == 1, _json_text(F.col("l_extendedprice").cast("string")))
        .otherwise(F.col("l_extendedprice").cast("string"))
        .alias("price_json"),
        (line % 2 == 0).alias("has_second"),
        F.when(part % 401 == 17, F.lit("[]")).when(part % 401 == 18, F.lit("null")).alias("no_items"),
        (part % 70 == 11).alias("repeated"),
    )
    return _twice_if(rows, F.col("repeated"))


def order_time_text(ordered_at: Column, time_format: Column) -> Column:
    """The order time as JSON text in one of its four raw formats."""
    local = F.from_utc_timestamp(ordered_at, "Asia/Baku")
    return (
        F.when(time_format == 0, F.unix_millis(ordered_at).cast("string"))
        .when(time_format == 1, _json_text(F.date_format(ordered_at, "yyyy-MM-dd'T'HH:mm:ss'Z'")))
        .when(time_format == 2, _json_text(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss'+04:00'")))
        .otherwise(_json_text(F.date_format(local, "dd.MM.yyyy HH:mm:ss")))
    )


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_orders(spark, sf_dir, spread=True)
    first = _object(
        product_id=_json_text(F.col("product_id")), quantity=F.col("quantity").cast("string"), unit_price=F.col("price_json")
    )
    second = _object(
        product_id=_json_text(F.col("second_product_id")), quantity=F.lit("1"), unit_price=F.lit("100.25")
    )
    both = F.when(F.col("has_second"), F.concat(first, F.lit(","), second)).otherwise(first)
    items = F.coalesce("no_items", F.concat(F.lit("["), both, F.lit("]")))
    payload = _object(
        order_id=_json_text(F.col("order_id")),
        customer_id=_json_text(F.col("customer_id")),
        channel=_json_text(F.col("channel")),
        currency=_json_text(F.col("currency")),
        order_ts=order_time_text(F.col("ordered_at"), F.col("time_format")),
        status=_json_text(F.col("status")),
        updated_at=_json_text(F.date_format("updated", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")),
        items=items,
    )
    rows = raw.select(
        "_record_id", payload.alias("payload"), F.col("order_id").alias("_order_id"), F.col("updated").alias("_updated_at")
    )
    return _audit(rows, "orders_api", F.lit("orders_all"))


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three full snapshots with new, changed, skipped, gone and repeated customers."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    number = F.col("_n")
    snapshots = F.array(
        F.when(key % 20 != 3, F.lit(1)), F.when(key % 25 != 4, F.lit(2)), F.when(key % 50 != 6, F.lit(3))
    )
    rows = _located(table(spark, sf_dir, "customer")).withColumn("_n", F.explode(F.array_compact(snapshots)))
    rows = rows.withColumn("_record_id", F.concat_ws(":", "_record_id", "_n"))
    rows = _twice_if(rows, key % 33 == 8)
    day = F.element_at(F.array(*[F.lit(d) for d in SNAPSHOT_DAYS]), number)
    older = F.col("_copy") == 1
    raw_country = F.element_at(
        F.array(
            *[F.lit(c) for c in ("azerbaijan", "AZE", " Azerbaijan ", "TURKEY", "Türkiye", "N/A", "Georgia", "")]
        ),
        (nation % 8 + 1).cast("int"),
    )
    rows = rows.select(
        F.when(key % 201 == 10, F.lit(""))
        .when(key % 203 == 12, F.lit(None))
        .otherwise(F.concat(F.lit("C"), "c_custkey"))
        .alias("customer_id"),
        F.col("c_name").alias("full_name"),
        raw_country.alias("country"),
        F.when(older, F.lit("OLD"))
        .when((number >= 2) & (key % 10 == 2), F.lit("VIP"))
        .when((number == 3) & (key % 15 == 1), F.lit("KEY"))
        .otherwise(F.col("c_mktsegment"))
        .alias("segment"),
        F.date_add(F.lit("2022-01-01").cast("date"), (key % 300).cast("int")).cast("string").alias("signup_date"),
        F.concat(day, F.when(older, "T00:30:00Z").otherwise("T01:00:00Z")).alias("updated_at"),
        day.alias("snapshot_date"),
        "_record_id",
    )
    return _audit(rows, "customers_csv", F.concat(F.lit("customers_"), "snapshot_date"))


def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    rows = _twice_if(_located(table(spark, sf_dir, "part")), key % 29 == 9)
    older = F.col("_copy") == 1
    rows = rows.select(
        F.when(key % 53 == 10, F.lit("")).otherwise(F.concat(F.lit("P"), "p_partkey")).alias("product_id"),
        F.when(older, F.concat(F.lit("old "), "p_name")).otherwise(F.col("p_name")).alias("product_name"),
        F.when(key % 31 == 5, F.lit("  ")).when(key % 31 == 6, F.lit("")).otherwise(F.col("p_type")).alias("category"),
        F.when(key % 37 == 4, F.lit("-5.00"))
        .when(key % 41 == 6, F.lit(""))
        .otherwise(F.format_number("p_retailprice", 2))
        .alias("unit_price"),
        F.when(key % 43 == 7, F.lit("AZM"))
        .otherwise(
            F.element_at(
                F.array(F.lit("azn"), F.lit(" USD"), F.lit("EUR"), F.lit("Try ")), (key % 4 + 1).cast("int")
            )
        )
        .alias("currency"),
        F.date_format(
            F.timestamp_seconds(F.lit(1767225600) + key - F.col("_copy") * 3600), "yyyy-MM-dd'T'HH:mm:ss'Z'"
        ).alias("updated_at"),
        "_record_id",
    )
    return _audit(rows, "products_csv", F.lit("products"))


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct order days, shifted."""
    return table(spark, sf_dir, "orders").select(
        F.date_from_unix_date(_day_number("o_orderdate") + ORDER_SHIFT_DAYS).alias("day")
    ).distinct()


def bronze_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rate document per weekday with orders, none at weekends or before the first rate day."""
    day = F.col("day")
    number = F.unix_date(day)

    def rate(currency: str, base: int, step: int) -> Column:
        amount = ((F.lit(base) + number % 7 * step) / F.lit(1000000)).cast("decimal(12,6)").cast("string")
        return _object(currency=F.lit(f'"{currency}"'), rate_azn=amount)

    rates = F.concat_ws(",", rate("USD", 1700000, 1000), rate("EUR", 1850000, 2500), rate("TRY", 50000, 125))
    days = order_days(spark, sf_dir).filter((F.weekday(day) < 5) & (day >= F.lit(FIRST_RATE_DAY).cast("date")))
    rows = days.select(
        day.cast("string").alias("rate_date"),
        _object(
            date=_json_text(day.cast("string")),
            quote_currency=F.lit('"AZN"'),
            note=F.lit("null"),
            rates=F.concat(F.lit("["), rates, F.lit("]")),
        ).alias("payload"),
    )
    return _audit(rows, "fx_api", F.lit("fx_all"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status-event fields: five consecutive events share an order, some orders are not known."""
    key, kind = F.col("event_id"), F.col("event_type")
    order = F.floor(key / 5).cast("bigint")
    status = (
        F.when(kind == "view", "CREATED")
        .when(kind == "click", "CONFIRMED")
        .when(kind == "signup", "PACKED")
        .when((kind == "purchase") & (key % 2 == 0), "SHIPPED")
        .when(kind == "purchase", "DELIVERED")
        .when(key % 3 == 0, "REFUNDED")
        .otherwise("CANCELLED")
    )
    erased = key % 211 == 3
    rows = _located(table(spark, sf_dir, "events")).select(
        "_record_id",
        F.when(key % 1009 == 5, F.lit(None))
        .when(key % 1013 == 6, F.lit(""))
        .otherwise(F.concat(F.lit("E"), "event_id"))
        .alias("event_id"),
        F.concat(F.lit("O"), order, F.lit("-"), order % 7 + 1).alias("order_id"),
        F.when(erased, "d").when(kind == "view", "c").otherwise("u").alias("op"),
        F.when(kind != "view", F.lit("CREATED")).alias("old_status"),
        F.when(~erased, status).alias("new_status"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        (key % 50 == 7).alias("repeated"),
    )
    return _twice_if(rows, F.col("repeated"))


def event_payload() -> Column:
    return _object(
        event_id=_json_text(F.col("event_id")),
        op=_json_text(F.col("op")),
        order_id=_json_text(F.col("order_id")),
        old_status=_json_text(F.col("old_status")),
        new_status=_json_text(F.col("new_status")),
        event_ts=_json_text(F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")),
        ingested_at=_json_text(
            F.date_format(F.timestamp_seconds(F.unix_seconds("event_ts") + 60 + F.col("_copy")), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        ),
        source=F.lit('"order-service"'),
    )


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_events(spark, sf_dir).select("_record_id", event_payload().alias("payload"))
    return _audit(rows, "events_ndjson", F.lit("events_all"))
