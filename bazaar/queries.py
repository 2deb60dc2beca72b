"""Every operator and model as a query over the star-schema tables."""

import functools
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar import functions as fn
from bazaar import standin
from bazaar.operators import asof, dedup, diff, joins, quality, rules, upsert
from bazaar.operators.scd2 import merged_series
from bazaar.plans import erasure, gold, governance, incremental, layout, places, reports, runner, silver, staging
from bazaar.schemas import CURRENCIES, EVENT_DOC, ORDER_DOC
from bazaar.session import CODEC, settle, shared_root, workspace
from bazaar.sources import landed, sinks
from bazaar.streaming import events as streaming

EVENT_CUT = "2024-01-20 00:00:00"
ORDER_CUT = "2025-06-01 00:00:00"

RUN_TABLES = [
    "bronze.orders", "bronze.customers", "bronze.products", "bronze.events",
    "silver.order_lines", "quarantine.order_lines", "silver.customers", "quarantine.customers",
    "silver.products", "quarantine.products", "silver.order_status_history", "quarantine.order_events",
    "silver.order_status_reconciliation", "gold.dim_customer", "gold.dim_product", "gold.fct_order_lines",
    "gold.fct_order_status_events",
]

REGISTRY: dict[str, Callable[["Inputs"], DataFrame]] = {}


def query(build: Callable[["Inputs"], DataFrame]) -> Callable[["Inputs"], DataFrame]:
    REGISTRY[build.__name__] = build
    return build


def present(df: DataFrame) -> DataFrame:
    """Plain result types, so that two engines can be compared: text days and times, doubles, bigints."""
    columns = []
    for field in df.schema.fields:
        col = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampType | T.TimestampNTZType):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DecimalType | T.FloatType):
            col = col.cast("double")
        elif isinstance(field.dataType, T.IntegerType | T.ShortType | T.ByteType):
            col = col.cast("bigint")
        columns.append(col.alias(field.name))
    return df.select(*columns)


# Tables that come out of a large join, whose partitions are even already: sizes are known there, and hot keys split.
EVEN = ("bronze_orders", "staged_lines", "early_lines", "fct_order_lines")

# Tables written in this application, by (application, work folder, data folder and its state, table); the last entry is
# what their folders held then.
_WRITTEN: dict[tuple[str, str, str, str], tuple[str, T.StructType, list]] = {}


def _listed(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """Name, time and size of all that a folder holds; nothing if it is not there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(where):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime(), s.getLen()) for s in fs.listStatus(where))


def _state(spark: SparkSession, sf_dir: str) -> str:
    """What the input folder holds now: other files, sizes or times make a shared table out of date."""
    return f"{sf_dir}|{_listed(spark, sf_dir)}"


def written(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A table of the lake, written on first use to the shared folder and read by every later plan.

    That is how the layers relate: loaders land bronze once, staging is built once, reports read them. It
    also cuts lineage in a way that survives lost executors. The rebalance makes files of even size where the plan does not.
    A table whose files went or changed since, as after `session.clean`, is written anew.
    """
    key = (spark.sparkContext.applicationId, shared_root(spark), _state(spark, sf_dir), name)
    if key not in _WRITTEN or _listed(spark, _WRITTEN[key][0]) != _WRITTEN[key][2]:
        rows, path = make(), workspace(spark, name)
        even = rows if name in EVEN else rows.hint("rebalance")
        even.write.option("compression", CODEC).parquet(path)
        _WRITTEN[key] = path, rows.schema, _listed(spark, path)
    path, schema, _ = _WRITTEN[key]
    return spark.read.schema(schema).parquet(path)


class Inputs:
    """The layers over one data folder, built lazily and only where a query asks."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = settle(spark, lake=True)
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return standin.table(self.spark, self.sf_dir, name)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("bronze_"):
            frame = self.built(name, lambda: getattr(standin, name)(self.spark, self.sf_dir))
            self.__dict__[name] = frame
            return frame
        raise AttributeError(name)

    @cached_property
    def staged_lines(self) -> DataFrame:
        return staging.order_lines(self.bronze_orders, self.bronze_customers, self.bronze_products)

    def built(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        return written(self.spark, self.sf_dir, name, make)

    def share_staged_lines(self) -> "Inputs":
        """For plans that read the staged lines more than once: read the written table."""
        fresh = self.staged_lines
        self.staged_lines = self.built("staged_lines", lambda: fresh)
        return self

    @cached_property
    def staged_customers(self) -> DataFrame:
        return staging.customers(self.bronze_customers)

    @cached_property
    def staged_products(self) -> DataFrame:
        return staging.products(self.bronze_products)

    @cached_property
    def staged_events(self) -> DataFrame:
        return staging.order_events(self.bronze_events, self.bronze_orders)

    @cached_property
    def lines(self) -> DataFrame:
        return silver.order_lines(self.staged_lines)

    @cached_property
    def customers(self) -> DataFrame:
        return silver.customers(self.staged_customers)

    @cached_property
    def history(self) -> DataFrame:
        return silver.status_history(self.staged_events)

    @cached_property
    def reconciliation(self) -> DataFrame:
        return silver.status_reconciliation(self.staged_lines, self.history)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return gold.dim_customer(self.customers)

    @cached_property
    def dim_product(self) -> DataFrame:
        return gold.dim_product(self.staged_products)

    @cached_property
    def dates(self) -> DataFrame:
        """A calendar that spans the data: order days and event days, and a day more on each side for the local zone."""
        return self.built("calendar", self._calendar)

    def _calendar(self) -> DataFrame:
        shifted = F.date_add(F.col("o_orderdate").cast("date"), standin.ORDER_SHIFT_DAYS)
        bounds = gold.day_bounds(self.table("orders").select(shifted), self.table("events").select(F.col("ts").cast("date")))
        return gold.dim_date(bounds.select(F.date_sub("first_day", 1).alias("first_day"), F.date_add("last_day", 2).alias("last_day")))

    @cached_property
    def rates(self) -> DataFrame:
        return gold.fx_rates(self.bronze_fx)

    @cached_property
    def fact(self) -> DataFrame:
        self.share_staged_lines()
        return gold.fct_order_lines(self.lines, self.rates, self.reconciliation, self.dates, self.gold_customers)

    @cached_property
    def status_fact(self) -> DataFrame:
        return gold.fct_order_status_events(self.history, self.dates)

    # Gold tables as the reports read them: written once, from the plans above.

    @cached_property
    def gold_customers(self) -> DataFrame:
        return self.built("dim_customer", lambda: self.dim_customer)

    @cached_property
    def gold_products(self) -> DataFrame:
        return self.built("dim_product", lambda: self.dim_product)

    @cached_property
    def gold_lines(self) -> DataFrame:
        return self.built("fct_order_lines", lambda: self.fact)

    @cached_property
    def gold_events(self) -> DataFrame:
        return self.built("fct_order_status_events", lambda: self.status_fact)

    @cached_property
    def order_days(self) -> DataFrame:
        """One row: first and last order day of the data, for a calendar that spans it."""
        day = F.col("o_orderdate").cast("date")
        return self.table("orders").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


# ---- scans, predicates, scalar functions


@query
def slice_half_open(i: Inputs) -> DataFrame:
    day = F.col("o_orderdate")
    low, high = F.lit("1997-01-01").cast("timestamp_ntz"), F.lit("1999-01-01").cast("timestamp_ntz")
    return i.table("orders").filter(upsert.in_range(day, low, high)).select("o_orderkey", "o_orderdate", "o_totalprice")


@query
def json_fields(i: Inputs) -> DataFrame:
    parsed = F.from_json("props", "k string")
    return i.table("events").select("event_id", parsed["k"].cast("bigint").alias("k"))


@query
def parse_mixed_ts(i: Inputs) -> DataFrame:
    raw = standin.raw_orders(i.spark, i.sf_dir)
    text = F.regexp_replace(standin.order_time_text(F.col("ordered_at"), F.col("time_format")), '"', "")
    return raw.select("order_id", "updated", text.alias("raw")).select(
        "order_id", F.col("updated").alias("updated_at"), fn.mixed_timestamp(F.col("raw")).alias("order_ts")
    )


@query
def ts_format_census(i: Inputs) -> DataFrame:
    raw = i.bronze_orders.select(F.from_json("payload", ORDER_DOC)["order_ts"].alias("raw"))
    return raw.groupBy(fn.timestamp_format(F.col("raw")).alias("format")).agg(F.count("*").alias("row_count"))


@query
def parse_price(i: Inputs) -> DataFrame:
    raw = standin.raw_orders(i.spark, i.sf_dir)
    text = F.nullif(F.regexp_replace("price_json", '"', ""), F.lit("null"))
    return raw.select("order_id", "updated", fn.price(text).alias("unit_price")).withColumnRenamed(
        "updated", "updated_at"
    )


@query
def norm_currency(i: Inputs) -> DataFrame:
    raw = i.bronze_orders.select(F.from_json("payload", ORDER_DOC)["currency"].alias("raw"))
    return raw.groupBy(fn.currency(F.col("raw")).alias("currency")).agg(F.count("*").alias("row_count"))


@query
def norm_country(i: Inputs) -> DataFrame:
    return i.bronze_customers.groupBy(fn.country(F.col("country")).alias("country")).agg(
        F.count("*").alias("row_count")
    )


@query
def local_date(i: Inputs) -> DataFrame:
    return i.table("events").select(
        "event_id", fn.local_date(F.col("ts").cast("timestamp")).alias("local_day")
    )


@query
def surrogate_key(i: Inputs) -> DataFrame:
    mark = F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY"))
    return i.table("customer").select("c_custkey", fn.joined_key(F.col("c_custkey").cast("string"), mark).alias("key"))


@query
def explode_items(i: Inputs) -> DataFrame:
    doc = i.bronze_orders.select(F.from_json("payload", ORDER_DOC).alias("doc")).select("doc.order_id", "doc.items")
    lines = staging.exploded_lines(doc)
    return lines.groupBy("order_id", "line_number").agg(
        F.count("*").alias("row_count"), F.sum("quantity").alias("quantity"), F.sum("unit_price").alias("unit_price")
    )


# ---- dedup, joins, dimensions


@query
def dedup_latest(i: Inputs) -> DataFrame:
    rows = i.table("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")
    return dedup.latest_by(
        rows, ["l_orderkey", "l_linenumber"], ["l_shipdate"], ["l_partkey", "l_suppkey", "l_extendedprice"]
    )


@query
def dedup_exact(i: Inputs) -> DataFrame:
    return staging.parsed_events(i.bronze_events)


@query
def ref_integrity(i: Inputs) -> DataFrame:
    ids = i.bronze_orders.select(F.from_json("payload", ORDER_DOC)["customer_id"].alias("customer_id"))
    flagged = joins.flag_known(ids, "customer_id", i.bronze_customers, "customer_id", "is_known")
    return flagged.groupBy("customer_id", "is_known").agg(F.count("*").alias("row_count"))


@query
def asof_fx(i: Inputs) -> DataFrame:
    """Order days against published rates, by the daily lookup."""
    return gold.with_rate(_priced_orders(i), i.rates, "day").select("o_orderkey", "currency", "day", "rate_azn")


@query
def asof_fx_large(i: Inputs) -> DataFrame:
    """The same join by the form that takes a right side of any size."""
    rows = _priced_orders(i)
    return joins.asof_join_large(rows, i.rates, ["currency"], "day", "rate_date", ["rate_azn"]).select(
        "o_orderkey", "currency", "day", "rate_azn"
    )


def _priced_orders(i: Inputs) -> DataFrame:
    codes = F.array(*[F.lit(c) for c in CURRENCIES])
    return i.table("orders").select(
        "o_orderkey",
        F.element_at(codes, (F.col("o_orderkey") % 4 + 1).cast("int")).alias("currency"),
        F.date_add(F.col("o_orderdate").cast("date"), standin.ORDER_SHIFT_DAYS).alias("day"),
    )


@query
def asof_fx_hot(i: Inputs) -> DataFrame:
    """Nine tenths of the left rows at different times of one currency and month; rates six times a day."""
    key = F.col("o_orderkey")
    hot = key % 10 != 0
    rows = i.table("orders").select(
        key,
        F.when(hot, "USD").otherwise("EUR").alias("currency"),
        F.timestamp_micros(
            F.when(hot, F.lit(1709251200000000) + key * 7919 * 1000003 % 2678400000000)
            .otherwise(F.unix_date(F.col("o_orderdate").cast("date")).cast("long") * 86400000000 + F.lit(9500 * 86400000000))
        ).alias("at"),
    )
    slots = i.rates.select("currency", "rate_date", "rate_azn", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("slot"))
    rates = slots.select(
        "currency", F.timestamp_seconds(F.unix_date("rate_date") * 86400 + F.col("slot") * 14400).alias("since"),
        (F.col("rate_azn") + F.col("slot")).alias("rate"),
    )
    return asof.asof_join_hot(rows, rates, ["currency"], "at", "since", ["rate"], per_range=200)


@query
def fx_missing_days(i: Inputs) -> DataFrame:
    bounds = i.order_days.select(
        F.date_add("first_day", standin.ORDER_SHIFT_DAYS).alias("since"),
        F.date_add("last_day", standin.ORDER_SHIFT_DAYS).alias("until"),
    )
    return landed.days_without_rates(i.bronze_fx, bounds)


@query
def dim_date(i: Inputs) -> DataFrame:
    return gold.dim_date(i.order_days)


@query
def dim_customer_scd2(i: Inputs) -> DataFrame:
    return i.dim_customer


@query
def dim_customer_merge(i: Inputs) -> DataFrame:
    """The dimension from snapshots that arrive newest first, one after the other, the last one twice."""
    days = [r["d"] for r in i.customers.select(F.col("snapshot_date").cast("string").alias("d")).distinct().orderBy(F.desc("d")).collect()]
    dimension, series = gold.dim_customer(i.customers.limit(0)), []
    for day in [*days, days[0]]:
        snapshot = i.customers.filter(F.col("snapshot_date") == F.lit(day).cast("date"))
        changed, fresh = gold.merge_customers(dimension, series, snapshot, day)
        merged = joins.anti_join(dimension, ["customer_id"], changed).unionByName(fresh)
        path = workspace(i.spark, "merged-dimension")
        merged.write.parquet(path)
        dimension, series = i.spark.read.schema(merged.schema).parquet(path), merged_series(series, day)
    return dimension


@query
def dim_customer_first_last(i: Inputs) -> DataFrame:
    return gold.dim_customer(i.customers, only_bounds=True)


@query
def scd2_interval_join(i: Inputs) -> DataFrame:
    rows = i.table("orders").select(
        "o_orderkey",
        F.concat(F.lit("C"), "o_custkey").alias("customer_id"),
        F.date_add(F.col("o_orderdate").cast("date"), standin.ORDER_SHIFT_DAYS).alias("day"),
    )
    versions = i.dim_customer.select("customer_id", "segment", "valid_from", "valid_to")
    return joins.interval_join(rows, versions, ["customer_id"], "day", "valid_from", "valid_to").select(
        "o_orderkey", "customer_id", "segment", "valid_from"
    )


@query
def dim_product(i: Inputs) -> DataFrame:
    return i.dim_product


# ---- staging, silver, quarantine


@query
def reject_reasons(i: Inputs) -> DataFrame:
    return i.staged_lines


@query
def reject_census(i: Inputs) -> DataFrame:
    return rules.census(i.staged_lines, "order_id")


@query
def stg_customers(i: Inputs) -> DataFrame:
    return i.staged_customers


@query
def stg_products(i: Inputs) -> DataFrame:
    return i.staged_products


@query
def stg_events(i: Inputs) -> DataFrame:
    return i.staged_events


@query
def silver_order_lines(i: Inputs) -> DataFrame:
    return i.lines


@query
def silver_customers(i: Inputs) -> DataFrame:
    return i.customers


@query
def silver_products(i: Inputs) -> DataFrame:
    return silver.products(i.staged_products)


@query
def silver_status_history(i: Inputs) -> DataFrame:
    return i.history


def _quarantine(rejects: DataFrame, *fields: str) -> DataFrame:
    """Rejects with some payload fields, and the number of fields kept in the document."""
    return rejects.select(
        "quarantine_id",
        "source",
        "reason_code",
        *[F.get_json_object("payload", f"$.{f}").alias(f"payload_{f}") for f in fields],
        F.size(F.json_object_keys("payload")).cast("bigint").alias("payload_fields"),
    )


@query
def quarantine_order_lines(i: Inputs) -> DataFrame:
    return _quarantine(silver.order_lines_rejected(i.staged_lines), "order_id", "customer_id", "product_id", "status")


@query
def quarantine_customers(i: Inputs) -> DataFrame:
    return _quarantine(silver.customers_rejected(i.staged_customers), "customer_id", "segment", "signup_date")


@query
def quarantine_products(i: Inputs) -> DataFrame:
    return _quarantine(silver.products_rejected(i.staged_products), "product_id", "product_name", "currency")


@query
def quarantine_events(i: Inputs) -> DataFrame:
    return _quarantine(silver.status_history_rejected(i.staged_events), "event_id", "order_id", "new_status")


@query
def status_reconciliation(i: Inputs) -> DataFrame:
    return i.share_staged_lines().reconciliation


@query
def status_census(i: Inputs) -> DataFrame:
    return i.share_staged_lines().reconciliation.groupBy("reconciliation_status").agg(F.count("*").alias("order_count"))


# ---- facts and reports


@query
def fct_order_lines(i: Inputs) -> DataFrame:
    return i.fact


@query
def fct_status_events(i: Inputs) -> DataFrame:
    return i.status_fact


@query
def report_reconciliation(i: Inputs) -> DataFrame:
    fact = i.share_staged_lines().gold_lines
    rejects = i.staged_lines.filter(F.col("reason_code").isNotNull())
    return reports.reconciliation_summary(i.bronze_orders, i.lines, rejects, fact)


@query
def report_monthly_revenue(i: Inputs) -> DataFrame:
    return reports.monthly_revenue(i.gold_lines, i.dates, i.gold_products, i.gold_customers)


@query
def report_top_customers(i: Inputs) -> DataFrame:
    return reports.top_customers(i.gold_lines, i.gold_customers)


@query
def report_funnel(i: Inputs) -> DataFrame:
    return reports.status_funnel(i.gold_events)


@query
def monthly_revenue_table(i: Inputs) -> DataFrame:
    """Monthly revenue as a table: built from the orders before a cut, then only the months that later ones touch."""
    path = workspace(i.spark, "monthly")
    cut = int(ORDER_CUT[:10].replace("-", ""))
    early = i.gold_lines.filter(F.col("order_date_key") < cut)
    reports.refresh_monthly_revenue(path, early, i.dates, i.gold_products, i.gold_customers)
    later = i.gold_lines.filter(F.col("order_date_key") >= cut).select(F.floor(F.col("order_date_key") / 100).alias("m")).distinct()
    touched = [f"{r['m'] // 100}-{r['m'] % 100:02d}" for r in later.collect()]  # months
    reports.refresh_monthly_revenue(path, i.gold_lines, i.dates, i.gold_products, i.gold_customers, touched)
    return i.spark.read.parquet(path).select("month", "category", "country", "recognized_revenue_azn")


@query
def report_aov(i: Inputs) -> DataFrame:
    return reports.average_order_value(i.gold_lines, i.dates)


@query
def report_lead_time(i: Inputs) -> DataFrame:
    return reports.delivery_lead_time(i.gold_events)


# ---- quality


@query
def dq_checks(i: Inputs) -> DataFrame:
    """The declared checks over staged and plain tables; some fail on purpose."""
    fact = i.share_staged_lines().gold_lines
    lines, products, customers = i.lines, silver.products(i.staged_products), i.gold_customers
    now = F.lit(standin.LANDED_AT).cast("timestamp") + F.expr("interval 7 days")
    return quality.all_results(
        [
            quality.run_row_checks("bronze.orders", i.bronze_orders, [quality.not_empty(), quality.fresh("_ingested_at", now)]),
            quality.run_row_checks(
                "silver.order_lines",
                lines,
                [quality.not_null(c) for c in ("order_id", "line_number", "customer_id", "product_id", "currency")]
                + [quality.accepted_values("currency", CURRENCIES)],
            ),
            quality.run_row_checks(
                "silver.products", products, [quality.not_null("product_id"), quality.accepted_values("currency", CURRENCIES)]
            ),
            quality.unique("silver.products", products, ["product_id"]),
            quality.unique("silver.order_lines", lines, ["order_id", "line_number"]),
            quality.unique("lineitem", i.table("lineitem"), ["l_orderkey", "l_linenumber"]),
            quality.run_row_checks("gold.dim_customer", customers, [quality.not_null("customer_key"), quality.not_null("valid_to")]),
            quality.relationship("gold.fct_order_lines", lines, "product_id", i.gold_products, "product_id"),
            quality.relationship("staging.order_lines", i.staged_lines, "product_id", i.gold_products, "product_id"),
            quality.same_count("gold.fct_order_lines", "grain", fact, lines),
            quality.run_row_checks("gold.fct_order_lines", fact, [quality.not_null("gross_amount_azn")]),
        ]
    )


# ---- incremental


@query
def incremental_by_event(i: Inputs) -> DataFrame:
    """The first run saw no tombstones before the cut; arriving late, they are dropped."""
    seen = i.history.filter((F.col("event_ts") < F.lit(EVENT_CUT).cast("timestamp")) & (F.col("op") != "d"))
    return incremental.status_history(i.staged_events, seen)


@query
def incremental_keep_late(i: Inputs) -> DataFrame:
    seen = i.history.filter((F.col("event_ts") < F.lit(EVENT_CUT).cast("timestamp")) & (F.col("op") != "d"))
    return incremental.status_history(i.staged_events, seen, late="keep")


def _early_bronze(i: Inputs) -> DataFrame:
    """The documents a run before the cut had seen."""
    return i.bronze_orders.filter(F.col("_updated_at") < F.lit(ORDER_CUT).cast("timestamp"))


def _early_lines(i: Inputs) -> DataFrame:
    """Staged lines of the early run, which its target and its watermark are both read from."""
    return i.built("early_lines", lambda: staging.order_lines(_early_bronze(i), i.bronze_customers, i.bronze_products))


@query
def incremental_by_order(i: Inputs) -> DataFrame:
    return incremental.order_lines(i.share_staged_lines().staged_lines, silver.order_lines(_early_lines(i)))


@query
def incremental_rejected(i: Inputs) -> DataFrame:
    target = silver.order_lines_rejected(_early_lines(i))
    return _quarantine(incremental.order_lines_rejected(i.share_staged_lines().staged_lines, target), "order_id", "product_id")


@query
def incremental_fact(i: Inputs) -> DataFrame:
    """Fact of an early run, brought up to date by the two cursors."""
    i.share_staged_lines()
    early_staged = _early_lines(i)
    early_lines = silver.order_lines(early_staged)
    early_history = i.history.filter(F.col("event_ts") < F.lit(EVENT_CUT).cast("timestamp"))
    early_status = silver.status_reconciliation(early_staged, early_history)
    target = gold.fct_order_lines(early_lines, i.rates, early_status, i.dates, i.gold_customers)
    return incremental.order_line_fact(
        target,
        i.lines,
        i.history,
        upsert.high_watermark(early_lines, F.col("updated_at")),
        upsert.high_watermark(early_history, F.col("event_ts")),
        i.rates,
        i.reconciliation,
        i.dates,
        i.gold_customers,
    ).select("order_id", "line_number", "customer_key", "gross_amount_azn", "final_status")


@query
def upsert_delete_insert(i: Inputs) -> DataFrame:
    """Orders before 2000 as the target; later ones, and all urgent ones anew and twice, as the batch."""
    orders = i.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    urgent = i.table("orders").filter(F.col("o_orderpriority") == "1-URGENT")
    again = urgent.select("o_orderkey", "o_custkey", F.lit("X").alias("o_orderstatus"), "o_orderdate")
    batch = orders.filter(F.col("o_orderdate") >= cut).unionByName(again).unionByName(again)
    return upsert.upsert(orders.filter(F.col("o_orderdate") < cut), batch, ["o_orderkey"])


@query
def replace_range(i: Inputs) -> DataFrame:
    """Finished orders of 1998 replace all orders of that year."""
    orders = i.table("orders").select("o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    low, high = F.lit("1998-01-01").cast("timestamp_ntz"), F.lit("1999-01-01").cast("timestamp_ntz")
    day = F.col("o_orderdate")
    batch = orders.filter(upsert.in_range(day, low, high) & (F.col("o_orderstatus") == "F"))
    batch = batch.withColumn("o_orderstatus", F.lit("R"))
    return upsert.replace_range(orders, batch, day, low, high)


@query
def reprocess_slice(i: Inputs) -> DataFrame:
    """One source's days are replaced; the other source's rows of the same days stay."""
    events = i.table("events").select(
        "event_id", "ts", "value", F.when(F.col("event_type") == "view", "web").otherwise("app").alias("_source")
    )
    low, high = F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-12").cast("timestamp_ntz")
    batch = events.filter((F.col("_source") == "web") & upsert.in_range(F.col("ts"), low, high))
    return sinks.replaced_slice(events, batch.withColumn("value", F.lit(0.0)), "web", F.col("ts"), low, high)


# ---- governance


@query
def masked_customers(i: Inputs) -> DataFrame:
    return governance.masked_customers(i.dim_customer)


@query
def erase_subjects(i: Inputs) -> DataFrame:
    subjects = i.table("customer").filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    kept = governance.erase(i.table("orders"), subjects, "o_custkey")
    return kept.select("o_orderkey", "o_custkey", "o_totalprice")


@query
def erase_layers(i: Inputs) -> DataFrame:
    """Rows that still name an erased person, per table of the lake, after erasing; and rows that are left."""
    i.share_staged_lines()
    subjects = i.bronze_customers.filter(F.col("customer_id").rlike("^C[0-9]*7$")).select("customer_id").distinct()
    quarantined = silver.order_lines_rejected(i.staged_lines)
    tables = {
        "bronze.orders": i.bronze_orders, "bronze.customers": i.bronze_customers, "quarantine.order_lines": quarantined,
        "silver.order_lines": i.lines, "gold.dim_customer": i.gold_customers, "gold.fct_order_lines": i.gold_lines,
    }
    kept = governance.erase_layers(tables, subjects)
    named = {name: rows.withColumn("_person", governance.persons_of(name)) for name, rows in kept.items() if name != "gold.fct_order_lines"}
    versions = i.gold_customers.select("customer_key", F.col("customer_id").alias("_person"))
    named["gold.fct_order_lines"] = joins.keyed_join(kept["gold.fct_order_lines"], versions, ["customer_key"])
    counted = []
    for name, rows in named.items():
        left = joins.semi_join(rows, ["_person"], subjects.withColumnRenamed("customer_id", "_person"))
        total = kept[name].agg(F.count("*").alias("n")).scalar()
        counted.append(left.agg(F.count("*").alias("naming_erased")).select(F.lit(name).alias("table_name"), "naming_erased", total.alias("row_count")))
    return functools.reduce(DataFrame.unionByName, counted)


# ---- files


@query
def src_order_pages(i: Inputs) -> DataFrame:
    """Every record of every response page, read back as raw documents; a truncated page is counted, not lost."""
    path = workspace(i.spark, "pages")
    pages = i.bronze_orders
    number = F.pmod(F.xxhash64("_record_id"), F.lit(max(1, pages.count() // 100)))
    page = F.to_json(
        F.struct(
            F.collect_list(F.from_json("payload", ORDER_DOC)).alias("data"),  # about a hundred records
            F.lit(None).cast("string").alias("next_cursor"),
            F.lit(200).alias("page_size"),
        ),
        {"ignoreNullFields": "false"},
    )
    whole = pages.groupBy(number.alias("page")).agg(page.alias("value")).select("value")
    cut = whole.agg(F.min("value").alias("value")).select(F.expr("left(value, length(value) - 9)").alias("value"))
    whole.unionByName(cut).write.option("compression", "gzip").text(path)
    records = landed.promoted(landed.order_pages(i.spark, path, strict=False))
    bad = landed.unreadable_pages(i.spark, path, landed.new_batch_id(), "orders_pages")
    found = records.select(
        F.col("_order_id").alias("order_id"),
        F.col("_updated_at").alias("updated_at"),
        F.get_json_object("payload", "$.items[0].product_id").alias("first_product"),
        F.lit("record").alias("kind"),
    )
    none = F.lit(None)
    return found.unionByName(
        bad.select(none.cast("string").alias("order_id"), none.cast("timestamp").alias("updated_at"), none.cast("string").alias("first_product"), F.col("reason_code").alias("kind"))
    )


@query
def src_fx_documents(i: Inputs) -> DataFrame:
    """Rate documents written and read back as landed, and the days of the orders that have none."""
    path = workspace(i.spark, "rates")
    i.bronze_fx.select(F.col("payload").alias("value")).write.text(path)
    documents = landed.fx_documents(i.spark, path)
    bounds = i.order_days.select(
        F.date_add("first_day", standin.ORDER_SHIFT_DAYS).alias("since"),
        F.date_add("last_day", standin.ORDER_SHIFT_DAYS).alias("until"),
    )
    missing = landed.days_without_rates(documents, bounds)
    return documents.select(F.col("rate_date").alias("day"), F.lit(True).alias("published")).unionByName(
        missing.select(F.col("day").cast("string"), F.lit(False).alias("published"))
    )


def _snapshot_files(i: Inputs) -> str:
    """Customer snapshots as CSV folders, one per snapshot day, each with its own column order."""
    path = workspace(i.spark, "snapshots")
    columns = staging.CUSTOMER[:-1]
    for n, day in enumerate(standin.SNAPSHOT_DAYS):
        rows = i.bronze_customers.filter(F.col("snapshot_date") == day).select(*columns[n:], *columns[:n])
        _write_csv(rows, f"{path}/customers_snapshot_{day}.csv")
    return path


def _write_csv(rows: DataFrame, path: str) -> None:
    """Quoted where needed, blanks kept."""
    rows.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


@query
def src_customers_csv(i: Inputs) -> DataFrame:
    rows = landed.customers_csv(i.spark, f"{_snapshot_files(i)}/*.csv")
    return rows.select(*staging.CUSTOMER)


@query
def src_products_csv(i: Inputs) -> DataFrame:
    path = workspace(i.spark, "products")
    _write_csv(i.bronze_products.select(*staging.PRODUCT), path)
    return landed.products_csv(i.spark, path)


@query
def src_optional(i: Inputs) -> DataFrame:
    """A source whose files are missing is empty, one whose file is there is read."""
    path = workspace(i.spark, "optional")
    i.table("nation").select("n_name").write.text(path)
    schema = T.StructType([T.StructField("value", T.StringType())])

    def read(where: str) -> DataFrame:
        return landed.optional(i.spark, where, schema, lambda: i.spark.read.text(where))[0]

    found, missing = read(path), read(f"{path}/none_*.csv")
    return found.unionByName(missing)


def _event_files(i: Inputs) -> str:
    """Event documents as NDJSON files, with a truncated copy of every tombstone line."""
    path = f"{workspace(i.spark, 'events')}/order_events_{standin.LANDED_AT[:10]}.ndjson"
    good = i.bronze_events.select("payload")
    erased = F.get_json_object("payload", "$.op") == "d"
    cut = good.filter(erased).select(F.expr("left(payload, length(payload) - 9)").alias("payload"))
    good.unionByName(cut).write.text(path)
    return path


@query
def src_event_lines(i: Inputs) -> DataFrame:
    """Line numbers run from 1 to the number of lines of each file: summed, they say whether each is there once."""
    lines = landed.event_lines(i.spark, _event_files(i))
    per_file = lines.groupBy("_source_file").agg(
        F.count("*").alias("n"), F.count_distinct("_line_no").alias("numbers"), F.max("_line_no").alias("last")
    )
    return per_file.agg(
        F.sum("n").alias("line_count"),
        F.bool_and((F.col("n") == F.col("numbers")) & (F.col("n") == F.col("last"))).alias("numbered"),
    )


@query
def ndjson_split(i: Inputs) -> DataFrame:
    events, bad = landed.split_events(landed.event_lines(i.spark, _event_files(i)), landed.new_batch_id())
    good_rows = events.select(F.lit("event").alias("kind"), F.from_json("payload", EVENT_DOC)["op"].alias("op"))
    bad_rows = bad.select(F.lit("quarantine").alias("kind"), F.lit(None).cast("string").alias("op"))
    return good_rows.unionByName(bad_rows).groupBy("kind", "op").agg(F.count("*").alias("row_count"))


@query
def audit_columns(i: Inputs) -> DataFrame:
    batch = landed.new_batch_id()
    load = F.lit(landed.range_load_id("orders", "1995-01-01", "2002-01-01"))
    rows = landed.audited(i.table("orders").select("o_orderkey"), landed.ORDERS_SOURCE, load, batch)
    return rows.agg(
        F.count("*").alias("row_count"),
        F.count_distinct("_record_id").alias("record_ids"),
        F.count_distinct("_batch_id").alias("batches"),
        F.min("_source").alias("source"),
        F.min("_load_id").alias("load_id"),
    )


@query
def replace_load(i: Inputs) -> DataFrame:
    """Four loads are written, then the middle one again with other rows, and the last one again without any."""
    path = workspace(i.spark, "loads")
    rows = i.bronze_customers.select("customer_id", "segment", "_load_id")
    ids = [f"customers_{day}" for day in standin.SNAPSHOT_DAYS]
    rows = rows.unionByName(rows.filter(F.col("_load_id") == ids[0]).withColumn("_load_id", F.lit("customers_again")))
    sinks.replace_loads(rows, path, [*ids, "customers_again"])
    sinks.replace_loads(rows.filter(F.col("_load_id") == ids[1]).withColumn("segment", F.lit("NEW")), path, [ids[1]])
    sinks.replace_loads(rows.limit(0), path, ["customers_again"])
    return i.spark.read.parquet(path).groupBy("_load_id", "segment").agg(F.count("*").alias("row_count"))


@query
def partition_layout(i: Inputs) -> DataFrame:
    path = workspace(i.spark, "layout")
    orders = i.table("orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("day"))
    sinks.write_by_month(orders, "day", path)
    return i.spark.read.parquet(path).groupBy("order_month").agg(F.count("*").alias("row_count"))


@query
def compact(i: Inputs) -> DataFrame:
    path, out = workspace(i.spark, "small"), workspace(i.spark, "compacted")
    month = F.date_format("ts", "yyyy-MM-dd").alias("day")
    i.table("events").select("event_id", "value", month).repartition(16).write.partitionBy("day").parquet(path)
    rows = sinks.compact(i.spark, path, out, ["day"])
    return rows.groupBy("day").agg(F.count("*").alias("row_count"), F.sum("event_id").alias("ids"))


@query
def export_csv(i: Inputs) -> DataFrame:
    path = workspace(i.spark, "report")
    sinks.export_csv(present(i.table("customer").groupBy("c_mktsegment").agg(F.count("*").alias("customers"))), path)
    return i.spark.read.csv(path, header=True, schema="c_mktsegment string, customers bigint")


def _two_intervals(i: Inputs) -> tuple[runner.Lake, dict[str, tuple[str, ...]]]:
    """A lake after two runs, the second one incremental, and the partitions that this one rewrote.

    Snapshots, catalogue and all events come with the first run; events of orders that only the second brings wait in
    quarantine until then. No run is told to start over.
    """
    root = workspace(i.spark, "lake")
    lake = runner.Lake(i.spark, root, f"lake_{root[-8:]}_")
    middle, now = ORDER_CUT[:10], F.lit(standin.LANDED_AT).cast("timestamp")

    def between(since: str, until: str) -> dict[str, DataFrame]:
        return {
            "orders": i.bronze_orders.filter(upsert.in_range(F.col("_updated_at"), *[F.lit(d).cast("timestamp") for d in (since, until)])),
            "fx_rates": i.bronze_fx.filter(upsert.in_range(F.col("rate_date"), F.lit(since), F.lit(until))),
        }

    first = between("2019-01-01", middle) | {"customers": i.bronze_customers, "products": i.bronze_products, "events": i.bronze_events}
    runner.run_interval(lake, first, "2019-01-01", middle, now, priced=False)
    moved = runner.run_interval(lake, between(middle, "2028-01-01"), middle, "2028-01-01", now, priced=False)
    return lake, moved


@query
def medallion_run(i: Inputs) -> DataFrame:
    """Rows and a sum of values of every published table after a first and an incremental interval."""
    return _all_tables(_two_intervals(i)[0])


@query
def revenue_after_runs(i: Inputs) -> DataFrame:
    """The revenue table that runs keep, after a first and an incremental interval."""
    return _two_intervals(i)[0].table("gold.monthly_revenue").select("month", "category", "country", "recognized_revenue_azn")


@query
def interval_partitions(i: Inputs) -> DataFrame:
    """The bronze partitions that the second interval rewrote: the months of its interval, no others."""
    _, moved = _two_intervals(i)
    return i.spark.createDataFrame([(n, p) for n in ("bronze.orders", "bronze.fx_rates") for p in moved[n] if p != runner.NONE], "table_name string, partition string")


def _all_tables(lake: runner.Lake) -> DataFrame:
    """Rows and a sum of values of every published table."""
    sums = {
        "silver.order_lines": F.sum(F.col("quantity") * F.col("line_number")),
        "quarantine.order_lines": F.sum(F.length("reason_code")),
        "silver.order_status_history": F.sum(F.length("new_status")),
        "quarantine.order_events": F.sum(F.length("reason_code")),
        "silver.order_status_reconciliation": F.sum(F.length(F.concat("final_status", "reconciliation_status"))),
        "gold.dim_customer": F.sum(F.length("segment")),
        "gold.fct_order_lines": F.round(F.sum("gross_amount_azn"), 2),
        "gold.fct_order_status_events": F.sum("event_date_key"),
    }
    rows = [
        lake.table(n).agg(F.count("*").alias("row_count"), sums.get(n, F.lit(0)).cast("double").alias("value_sum")).select(F.lit(n).alias("table_name"), "row_count", "value_sum")
        for n in RUN_TABLES
    ]
    return functools.reduce(DataFrame.unionByName, rows)


def _lake(i: Inputs, **options) -> runner.Lake:
    root = workspace(i.spark, "lake")
    return runner.Lake(i.spark, root, f"lake_{root[-8:]}_", **options)


@query
def rerun_interval(i: Inputs) -> DataFrame:
    """All tables after an interval ran with other documents and events first: some too many, some changed, some missing.

    The second run replaces the interval; nothing is built from scratch, and nothing of the first version is left.
    """
    lake, now = _lake(i), F.lit(standin.LANDED_AT).cast("timestamp")
    part = lambda n: F.pmod(F.xxhash64("_record_id"), F.lit(n))

    def other(rows: DataFrame, change, more) -> DataFrame:
        known = rows.filter(part(7) != 0).withColumn("payload", F.when(part(5) == 1, change).otherwise(F.col("payload")))
        extra = rows.filter(part(9) == 2).withColumn("payload", more).withColumn("_record_id", F.concat("_record_id", F.lit(":x")))
        return known.unionByName(extra)

    orders = other(i.bronze_orders, F.replace("payload", F.lit('"CREATED"'), F.lit('"SHIPPED"')), F.replace("payload", F.lit('"order_id":"O'), F.lit('"order_id":"Q')))
    orders = landed.promoted(orders.drop("_order_id", "_updated_at")).select(*i.bronze_orders.columns)
    events = other(i.bronze_events, F.replace("payload", F.lit("order-service"), F.lit("other-service")), F.replace("payload", F.lit('"event_id":"E'), F.lit('"event_id":"F')))
    whole = {"customers": i.bronze_customers, "products": i.bronze_products, "fx_rates": i.bronze_fx}
    runner.run_interval(lake, {"orders": orders, "events": events} | whole, "2019-01-01", "2028-01-01", now, priced=False)
    runner.run_interval(lake, {"orders": i.bronze_orders, "events": i.bronze_events}, "2019-01-01", "2028-01-01", now, priced=False)
    return _all_tables(lake)


@query
def erased_lake(i: Inputs) -> DataFrame:
    """Rows of every table after persons were erased from a published lake, and how many rows still name one."""
    lake, now = _lake(i), F.lit(standin.LANDED_AT).cast("timestamp")
    feeds = {"orders": i.bronze_orders, "customers": i.bronze_customers, "products": i.bronze_products, "events": i.bronze_events, "fx_rates": i.bronze_fx}
    runner.run_interval(lake, feeds, "2019-01-01", "2028-01-01", now, priced=False)
    subjects = i.bronze_customers.filter(F.col("customer_id").rlike("^C[0-9]*7$")).select("customer_id").distinct()
    erasure.erase(lake, subjects)
    names = ["bronze.orders", "bronze.events", "bronze.customers", "silver.order_lines", "quarantine.order_lines", "silver.order_status_history", "quarantine.order_events", "silver.order_status_reconciliation", "gold.dim_customer", "gold.fct_order_lines", "gold.fct_order_status_events"]
    left = erasure.left_of(lake, subjects)
    return runner.table_counts(lake, names).join(left, "table_name", "left")


@query
def stray_rows(i: Inputs) -> DataFrame:
    """Documents per month after a feed brought, besides its interval, rows of earlier months, and was landed twice."""
    lake, middle = _lake(i), ORDER_CUT[:10]
    early = F.col("_updated_at") < F.lit(middle).cast("timestamp")
    stray = F.col("_order_id").endswith("-3")
    runner.land(lake, {"orders": i.bronze_orders.filter(early & ~stray)}, "2019-01-01", middle)
    lake.publish()
    for _ in range(2):
        runner.land(lake, {"orders": i.bronze_orders.filter(~early | stray)}, middle, "2028-01-01")
        lake.publish()
        lake.vacuum("bronze.orders")  # what this landing gave way to
    rows = lake.table("bronze.orders").groupBy(F.date_format("_updated_at", "yyyy-MM").alias("month"))
    return rows.agg(F.count("*").alias("row_count"), F.count_if(F.col("_part") != F.date_format("_updated_at", "yyyy-MM")).alias("misplaced"))


@query
def partition_plan(i: Inputs) -> DataFrame:
    """Labels and splits of the days with documents, for small and for large partitions."""
    sizes = i.bronze_orders.groupBy(layout.day_of("_updated_at").alias("day")).agg(F.count("*").alias("n"))
    plans = [layout.planned(sizes, None, target).withColumn("target", F.lit(target)) for target in (20, 600, 50_000)]
    return functools.reduce(DataFrame.unionByName, plans)


@query
def day_partitions(i: Inputs) -> DataFrame:
    """What a run of one day rewrites in a lake of days: that day, and the day of a row that strayed into it."""
    lake = _lake(i, target=1)
    day = lambda since, until: i.bronze_orders.filter(upsert.in_range(F.col("_updated_at"), *[F.lit(d).cast("timestamp") for d in (since, until)]))
    runner.land(lake, {"orders": day("2025-03-01", "2025-03-22")}, "2025-03-01", "2025-03-22")
    lake.publish()
    again = day("2025-03-11", "2025-03-12")
    stray = day("2025-03-20", "2025-03-21").filter(F.col("_order_id").endswith("-1"))
    runner.land(lake, {"orders": again.unionByName(stray)}, "2025-03-11", "2025-03-12")
    moved = lake.publish()["bronze.orders"]
    days = sorted({p.split(".")[0] for p in moved} - {runner.NONE})
    rows = lake.table("bronze.orders").groupBy(F.date_format("_updated_at", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("row_count"))
    return rows.withColumn("rewritten", F.col("day").isin(days))


@query
def order_places(i: Inputs) -> DataFrame:
    """The partitions that the index names for each order, without a look at the documents."""
    lake, middle = _lake(i), ORDER_CUT[:10]
    early = F.col("_updated_at") < F.lit(middle).cast("timestamp")
    for rows, since, until in ((i.bronze_orders.filter(early), "2019-01-01", middle), (i.bronze_orders.filter(~early), middle, "2028-01-01")):
        runner.land(lake, {"orders": rows}, since, until)
        lake.publish()
    found = runner.places_of(lake).filter(F.col("tab") == "bronze.orders")
    return found.select(F.col(places.ENTITY).alias("order_id"), F.explode("parts").alias("part"))


@query
def version_diff(i: Inputs) -> DataFrame:
    """Orders of two versions of the same table: what was added, removed, or is there more or less often."""
    old = i.table("orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("string").alias("price"))
    new = old.filter("o_orderkey % 7 <> 3").withColumn("price", F.when(F.col("o_orderkey") % 11 == 4, "0").otherwise(F.col("price")))
    new = new.unionByName(old.filter("o_orderkey % 13 = 5")).unionByName(old.filter("o_orderkey % 17 = 1").withColumn("o_orderkey", -F.col("o_orderkey")))
    found = diff.version_diff(old, new, ["o_orderkey"], F.concat_ws("|", "o_custkey", "price"))
    return found


@query
def moved_events(i: Inputs) -> DataFrame:
    """Accepted events after some came again, corrected, under the same id."""
    later = F.expr("timestampadd(HOUR, 1, _ingested_at)")
    fixed = i.bronze_events.filter(F.substring(F.get_json_object("payload", "$.event_id"), 2, 20).try_cast("long") % 6 == 1)
    fixed = fixed.withColumn("payload", F.replace("payload", F.lit("order-service"), F.lit("corrected"))).withColumn("_ingested_at", later).withColumn("_record_id", F.concat("_record_id", F.lit(":c")))
    both = landed.promoted_events(i.bronze_events.unionByName(fixed))
    events = silver.status_history(staging.order_events(runner.newest_events(both), i.bronze_orders))
    return events.groupBy("source").agg(F.count("*").alias("row_count"), F.countDistinct("event_id").alias("ids"))


# ---- streaming


@query
def stream_events(i: Inputs) -> DataFrame:
    return streaming.landed_events(i.spark, _streamed(i)[0])


def _streamed(i: Inputs) -> tuple[str, str, str]:
    """Two arrivals: the events of all days, then late ones and repeats of the same days again."""
    source, out, bad = _event_files(i), workspace(i.spark, "stream"), workspace(i.spark, "stream-bad")
    state = workspace(i.spark, "stream-state")
    early = F.pmod(F.xxhash64("value"), F.lit(3)) > 0
    folder = workspace(i.spark, "stream-in")
    i.spark.read.text(source).filter(early).write.text(f"{folder}/first")
    lines = streaming.stream_lines(i.spark, f"{folder}/*")
    streaming.land_events(lines, out, state, bad)
    i.spark.read.text(source).write.text(f"{folder}/second")
    streaming.land_events(lines, out, state, bad)
    return out, bad, folder


@query
def stream_accounting(i: Inputs) -> DataFrame:
    """Every line that arrived is an event, a repeat of one, or in quarantine."""
    out, bad, folder = _streamed(i)
    arrived = i.spark.read.text(f"{folder}/*").filter(F.trim("value") != "")
    good = arrived.filter(landed.is_json(F.col("value"))).agg(F.count("*").alias("n")).scalar()
    landed_rows = streaming.landed_events(i.spark, out).agg(F.count("*").alias("n")).scalar()
    return i.spark.read.parquet(bad).agg(F.count("*").alias("quarantined")).select(
        landed_rows.alias("landed"),
        (F.col("quarantined") + good == arrived.agg(F.count("*").alias("n")).scalar()).alias("all_accounted"),
        (good >= landed_rows).alias("repeats_not_negative"),
    )


@query
def stream_latest_status(i: Inputs) -> DataFrame:
    source, out = _event_files(i), workspace(i.spark, "status")
    streaming.keep_latest_status(streaming.stream_lines(i.spark, source), out, workspace(i.spark, "status-state"))
    return streaming.latest_status(i.spark, out).select("order_id", "op", "new_status", "event_ts")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: present(build(Inputs(spark, sf_dir)))

    return {name: runner(build) for name, build in REGISTRY.items()}
