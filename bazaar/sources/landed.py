"""Readers for landed files: response pages, rate documents, CSV snapshots, NDJSON event files."""

import csv
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.functions import joined_key
from bazaar.schemas import CUSTOMER_CSV, ORDER_PAGE, PRODUCT_CSV

ORDERS_SOURCE = "orders_api"
FX_SOURCE = "fx_api"
CUSTOMERS_SOURCE = "customers_csv"
PRODUCTS_SOURCE = "products_csv"
EVENTS_SOURCE = "events_ndjson"
PRODUCTS_LOAD = "products"


def new_batch_id() -> str:
    return uuid.uuid4().hex


def range_load_id(prefix: str, since: str, until: str) -> str:
    return f"{prefix}_{since}_{until}"


def file_date(path: Column) -> Column:
    """The day in `..._<day>.<suffix>`; the named thing may be a file or a folder of part files."""
    return F.regexp_extract(path, r"_(\d{4}-\d{2}-\d{2})\.[^/]*(/[^/]*)?$", 1)


def audited(rows: DataFrame, source: str, load_id: Column, batch_id: str) -> DataFrame:
    """Adds the audit columns and a record id that is unique in the batch; write the result before using it."""
    return rows.select(
        "*",
        F.lit(source).alias("_source"),
        F.lit(batch_id).alias("_batch_id"),
        load_id.alias("_load_id"),
        F.current_timestamp().alias("_ingested_at"),
        F.concat_ws(":", F.lit(batch_id), F.monotonically_increasing_id()).alias("_record_id"),
    )


def paths(spark: SparkSession, pattern: str) -> list[str]:
    """What a path or glob matches on its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    matches = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [m.getPath().toString() for m in matches or []]


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path or glob matches anything on its file system."""
    return bool(paths(spark, pattern))


def optional(spark: SparkSession, pattern: str, schema: T.StructType, read) -> tuple[DataFrame, bool]:
    """`read()` and True when files are there, else an empty frame of the schema and False: skip the write."""
    if exists(spark, pattern):
        return read(), True
    return spark.createDataFrame([], schema), False


UNREADABLE = "_unreadable"


def _pages(spark: SparkSession, path: str, one_page_per_file: bool) -> DataFrame:
    """Pages, which are files or lines; one that is no page keeps its text in `_unreadable`."""
    schema = T.StructType([*ORDER_PAGE.fields, T.StructField(UNREADABLE, T.StringType())])
    reader = spark.read.schema(schema).option("multiLine", one_page_per_file)
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", UNREADABLE).json(path)


def order_pages(spark: SparkSession, path: str, one_page_per_file: bool = False, strict: bool = True) -> DataFrame:
    """Every record of every landed page as raw JSON text.

    An unreadable page stops the read; with strict=False it is left to `unreadable_pages`, never just lost.
    """
    pages = _pages(spark, path, one_page_per_file)
    if strict:
        told = F.raise_error(F.concat(F.lit("unreadable page: "), F.left(UNREADABLE, F.lit(200))))
        pages = pages.withColumn("data", F.when(F.col(UNREADABLE).isNotNull(), told.cast("array<string>")).otherwise(F.col("data")))
    return pages.select(F.explode("data").alias("payload"))


def unreadable_pages(spark: SparkSession, path: str, batch_id: str, load_id: str, one_page_per_file: bool = False) -> DataFrame:
    """Quarantine records of the pages that `order_pages(strict=False)` passes over."""
    pages = _pages(spark, path, one_page_per_file).select("page_size", UNREADABLE, F.col("_metadata.file_name").alias("_file"))
    # The size, null on such pages, is named because Spark refuses to read the unreadable text alone.
    raw = pages.filter(F.col(UNREADABLE).isNotNull() & F.col("page_size").isNull()).select("_file", F.col(UNREADABLE).alias("raw"))
    return _quarantined(raw, ORDERS_SOURCE, F.lit(load_id), batch_id, "unreadable_page", F.xxhash64("_file", "raw").cast("string"))


def _quarantined(rows: DataFrame, source: str, load_id: Column, batch_id: str, reason: str, place: Column) -> DataFrame:
    """Quarantine records of raw texts (column `raw`)."""
    return rows.select(
        joined_key(F.lit(source), load_id, place).alias("quarantine_id"),
        F.lit(source).alias("source"),
        F.lit(batch_id).alias("_batch_id"),
        load_id.alias("_load_id"),
        F.lit(reason).alias("reason_code"),
        F.to_json(F.struct(F.col("raw"))).alias("payload"),
        F.current_timestamp().alias("quarantined_at"),
    )


def record_key(bronze: DataFrame) -> str:
    """What tells the rows of a bronze table apart."""
    return "_record_id" if "_record_id" in bronze.columns else "payload"


def unreadable_documents(bronze: DataFrame) -> DataFrame:
    """Quarantine records of landed documents that are no JSON: no model would see them."""
    bad = bronze.filter(~F.coalesce(is_json(F.col("payload")), F.lit(False)))
    return bad.select(
        joined_key("_source", "_load_id", record_key(bronze)).alias("quarantine_id"),
        F.col("_source").alias("source"),
        "_batch_id",
        "_load_id",
        F.lit("malformed_json").alias("reason_code"),
        F.to_json(F.struct(F.col("payload").alias("raw"))).alias("payload"),
        F.current_timestamp().alias("quarantined_at"),
    )


def promoted(records: DataFrame) -> DataFrame:
    """Adds `_order_id` and `_updated_at`, read from the document once at landing.

    The payload stays as received; finding the latest version, the known orders or an update range then
    reads narrow columns with file statistics instead of every document.
    """
    keys = F.from_json("payload", "order_id string, updated_at string")
    return records.withColumns({"_order_id": keys["order_id"], "_updated_at": keys["updated_at"].cast("timestamp")})


def promoted_events(records: DataFrame) -> DataFrame:
    """Adds `_event_id` and `_order_id` of status events, where they are not there already."""
    if "_event_id" in records.columns:
        return records
    keys = F.from_json("payload", "event_id string, order_id string")
    return records.withColumns({"_event_id": keys["event_id"], "_order_id": keys["order_id"]})


def order_slice(records: DataFrame, since: str, until: str) -> DataFrame:
    """Promoted records updated in `[since, until)`."""
    updated = F.col("_updated_at")
    return records.filter((updated >= F.lit(since).cast("timestamp")) & (updated < F.lit(until).cast("timestamp")))


def fx_documents(spark: SparkSession, path: str, one_document_per_file: bool = False) -> DataFrame:
    """One row per published day."""
    read = spark.read.text(path, wholetext=one_document_per_file)
    return read.filter(F.trim("value") != "").select(
        F.get_json_object("value", "$.date").alias("rate_date"), F.col("value").alias("payload")
    )


def days_without_rates(documents: DataFrame, span: DataFrame) -> DataFrame:
    """Days of `[since, until)` (one row: columns `since`, `until`) that have no document."""
    days = span.filter(F.col("since") < F.col("until")).select(
        F.explode(F.sequence("since", F.date_sub("until", 1))).alias("day")
    )
    published = documents.select(F.col("rate_date").cast("date").alias("day")).distinct()
    return days.join(published, "day", "left_anti")


def _headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files by their column names in order: one short row per file, read from its first line."""
    first = F.min_by("value", F.struct("block", "seq"))
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )
    heads = lines.filter("block = 0").groupBy("file").agg(first.alias("head")).collect()
    found: dict[tuple[str, ...], list[str]] = {}
    for row in heads:
        names = next(csv.reader([row["head"].lstrip("\ufeff")]))
        found.setdefault(tuple(n.strip() for n in names), []).append(row["file"])
    return found


def _text_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool) -> DataFrame:
    """RFC 4180 rows by column name, all text. The reader gives null for an empty field; the feed means ''.

    Each distinct header is read with its own column order. Files are split between tasks unless fields may hold
    line feeds (`multi_line`), which makes a file one task.
    """
    parts = []
    for names, files in sorted(_headers(spark, path).items()):
        own = T.StructType([T.StructField(n, T.StringType()) for n in names])
        rows = spark.read.schema(own).csv(files, header=True, quote='"', escape='"', multiLine=multi_line, enforceSchema=False)
        filled = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in schema.names]
        parts.append(rows.select(*filled, F.col("_metadata.file_path").alias("_file")))
    if not parts:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("_file", T.StringType())]))
    return reduce(DataFrame.unionByName, parts)


def customers_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Customer snapshots; the snapshot day comes from the file name."""
    return _text_csv(spark, path, CUSTOMER_CSV, multi_line).select(
        *CUSTOMER_CSV.names, file_date(F.col("_file")).alias("snapshot_date")
    )


def products_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return _text_csv(spark, path, PRODUCT_CSV, multi_line).select(*PRODUCT_CSV.names)


def event_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines, stripped, with file name, file date and 1-based line number.

    A file block is read in order by one task, so a line's number is its place in the block plus the lines
    of the blocks before it. Only the per-block counts are windowed and joined; a block is bounded in size.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_name").alias("_source_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
        F.trim("value", F.lit(" \t\r\n\f\v")).alias("value"),
    )
    earlier = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        lines.groupBy("_path", "_block")
        .agg(F.min("_seq").alias("_first"), F.count("*").alias("_lines"))
        .select("_path", "_block", (F.coalesce(F.sum("_lines").over(earlier), F.lit(0)) - F.col("_first")).alias("_add"))
    )
    return (
        lines.join(offsets, ["_path", "_block"])
        .filter(F.col("value") != "")
        .select(
            "value",
            "_source_file",
            (F.col("_seq") + F.col("_add") + 1).cast("int").alias("_line_no"),
            file_date(F.col("_path")).alias("file_date"),
        )
    )


def is_json(text: Column) -> Column:
    return F.try_parse_json(text).isNotNull()


def split_events(lines: DataFrame, batch_id: str) -> tuple[DataFrame, DataFrame]:
    """Bronze events and quarantine records: lines that are JSON, and lines that are not."""
    load_id = F.concat(F.lit("events_"), "file_date")
    tagged = lines.withColumn("_load_id", load_id)
    audit = [F.lit(EVENTS_SOURCE).alias("_source"), F.lit(batch_id).alias("_batch_id"), "_load_id"]
    events = tagged.filter(is_json(F.col("value"))).select(
        F.col("value").alias("payload"),
        "_source_file",
        "_line_no",
        *audit,
        F.current_timestamp().alias("_ingested_at"),
        F.concat_ws(":", "_source_file", "_line_no").alias("_record_id"),
    )
    bad = tagged.filter(~is_json(F.col("value"))).withColumnRenamed("value", "raw")
    return events, _quarantined(bad, EVENTS_SOURCE, F.col("_load_id"), batch_id, "malformed_json", F.col("_line_no"))
