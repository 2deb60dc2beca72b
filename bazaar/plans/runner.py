"""One interval from feeds to gold: land, check, model, check, publish.

What drives the models is the difference between the slice that an interval replaces and what it brings: orders with a
document or event that was added, changed or removed (`bronze.changed_orders`) are staged anew from everything bronze
holds of them, and replaced in every table. An index (`bronze.places`) names the partitions that hold them, so no
history is searched. Orders stay on that list until gold is published.
"""

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.functions import local_date
from bazaar.operators import quality
from bazaar.operators.diff import changed_keys, digest, version_diff
from bazaar.operators.joins import anti_join, keyed_join, semi_join
from bazaar.operators.scd2 import merged_series
from bazaar.operators.upsert import in_range
from bazaar.plans import gold, layout, places, reports, silver, staging
from bazaar.plans.places import ENTITY
from bazaar.schemas import CURRENCIES
from bazaar.session import CODEC, remove
from bazaar.sources import landed, sinks

WRITERS = 4
NONE = layout.NONE
BRONZE = {"records": "quarantine.records"}
FOLD = 24  # runs of the index that are kept apart
BUCKETS = 64  # partitions of the customer dimension
MERGED_DAYS = 4  # snapshots that are merged one by one; with more, all versions are built
#: Tables that share a plan of days, after the table whose rows are counted for it.
PLANS = {
    "bronze.orders": ("bronze.orders",),
    "silver.order_lines": ("silver.order_lines", "quarantine.order_lines", "silver.order_status_reconciliation", "gold.fct_order_lines"),
    "silver.order_status_history": ("silver.order_status_history", "quarantine.order_events", "gold.fct_order_status_events"),
}
PARTED = [t for tables in PLANS.values() for t in tables]
GOLD = ("gold.fct_order_lines", "gold.fct_order_status_events")
SILVER = tuple(t for t in PARTED if t not in GOLD and t != "bronze.orders")
#: Tables that keep the entity as a column; the others have it in their order id.
WITH_ENTITY = ("bronze.orders", "bronze.events", "quarantine.order_lines", "quarantine.order_events")


@dataclass
class Change:
    """What a run has written for a table and not published: a whole version, or the new content of some partitions."""

    path: str
    rows: DataFrame
    key: str | None = None
    touched: tuple[str, ...] = ()
    written: tuple[str, ...] = ()
    anew: bool = False  # the table gets other partition columns


@dataclass
class Lake:
    """Tables of the four layers; data lives under `root`, database names get `prefix`.

    Writes are versions that nobody sees. `publish` moves the tables, or the touched partitions of them, to them; `check`
    forgets them when a gate fails, so that no later run publishes them. A publish notes what it is about to do first;
    if it is stopped in between, the next Lake over the same root ends it, so readers of a started lake see all tables of
    a publish or none. One lake writes at a time. `target` is the number of rows that a partition should hold.
    """

    spark: SparkSession
    root: str
    prefix: str = ""
    pending: dict[str, Change] = field(default_factory=dict)
    target: int = layout.TARGET

    def __post_init__(self):
        sinks.create_layers(self.spark, self.root, self.prefix)
        for note, moves in sinks.journals(self.spark, self.root).items():
            self._move(moves)
            remove(self.spark, note)

    def has(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.prefix + name)

    def table(self, name: str) -> DataFrame:
        """The published table."""
        return self.spark.table(self.prefix + name)

    def partitions(self, name: str) -> list[str]:
        """Values of a partitioned table's only partition column."""
        if not self.has(name):
            return []
        return [unquote(r[0].split("=", 1)[1]) for r in self.spark.sql(f"SHOW PARTITIONS {self.prefix}{name}").collect()]

    def current(self, name: str) -> DataFrame:
        """The table as it would be published now."""
        change = self.pending.get(name)
        if change is None:
            return self.table(name)
        if change.key is None or change.anew or not self.has(name):
            return change.rows
        old = self.table(name).filter(~F.col(change.key).isin(*change.touched, *change.written))
        return old.unionByName(change.rows)

    def write(self, name: str, rows: DataFrame) -> DataFrame:
        """Write a new version without publishing it; returns the written rows."""
        path = sinks.write_version(rows, self.root, name)
        self.pending[name] = Change(path, self.spark.read.schema(rows.schema).parquet(path))
        return self.pending[name].rows

    def write_partitions(self, name: str, rows: DataFrame, key: str, touched: list[str], dealt: bool = False) -> DataFrame:
        """Write the whole new content of the touched partitions of `key`; the others are neither read nor written.

        `dealt` rows are written as they lie: they go to one partition, or to few from every task.
        """
        rows = rows.select(*[c for c in rows.columns if c != key], F.coalesce(F.col(key), F.lit(NONE)).alias(key))
        path = f"{self.root}/{name.replace('.', '/')}/v-{uuid.uuid4().hex}"
        (rows if dealt else rows.hint("rebalance", key)).write.partitionBy(key).option("compression", CODEC).parquet(path)
        found = self.spark.read.schema(rows.schema).parquet(path)
        written = tuple(r[0] for r in found.select(key).distinct().collect())  # partitions of one run
        self.pending[name] = Change(path, found, key, tuple(touched), written)
        return found

    def write_all(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Write tables that do not read each other; their jobs share the cluster, a few at a time."""
        with ThreadPoolExecutor(WRITERS) as pool:
            return dict(zip(tables, pool.map(self.write, tables.keys(), tables.values())))

    def check(self, results: DataFrame) -> None:
        """Raise when a check failed; what this run has written is then forgotten."""
        try:
            quality.gate(results)
        except quality.ChecksFailed:
            self.pending.clear()
            raise

    def publish(self) -> dict[str, tuple[str, ...]]:
        """Point the tables at what was written since the last publish; returns the partitions that moved."""
        moves = []
        for name, change in self.pending.items():
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in change.rows.schema.fields)
            moves.append({"name": name, "path": change.path, "key": change.key, "touched": change.touched, "written": change.written, "columns": columns, "anew": change.anew})
        note = sinks.write_journal(self.spark, self.root, moves)
        self._move(moves)
        remove(self.spark, note)
        self.pending.clear()
        return {m["name"]: tuple(sorted({*m["touched"], *m["written"]})) for m in moves if m["key"]}

    def _move(self, moves: list[dict]) -> None:
        """Do what a note says; doing it twice, or again from the middle, gives the same."""
        for m in moves:
            table = self.prefix + m["name"]
            if m["key"] is None:
                sinks.publish(self.spark, table, m["path"])
                continue
            if m["anew"]:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            if not self.has(m["name"]):
                base = f"{self.root}/{m['name'].replace('.', '/')}/base"
                self.spark.sql(f"CREATE TABLE {table} ({m['columns']}) USING parquet PARTITIONED BY (`{m['key']}`) LOCATION '{base}'")
            sinks.publish_partitions(self.spark, table, m["key"], m["path"], tuple(m["touched"]), tuple(m["written"]))

    def folders(self) -> list[str]:
        """Names that have data under the root, tables or what runs left."""
        found = landed.paths(self.spark, f"{self.root}/*/*")
        return sorted(".".join(p.rsplit("/", 2)[1:]) for p in found if p.rsplit("/", 2)[1] in sinks.LAYERS)

    def vacuum(self, name: str) -> int:
        """Delete the versions of a table that nothing points at any more; returns how many."""
        live = sinks.locations(self.spark, self.prefix + name) if self.has(name) else set()
        live |= {c.path for n, c in self.pending.items() if n == name}
        return sinks.drop_versions(self.spark, f"{self.root}/{name.replace('.', '/')}", live)


def _entity_of(name: str) -> Column:
    return F.col(ENTITY) if name in WITH_ENTITY else places.entity()


def plan_of(lake: Lake, lead: str, days: DataFrame | None = None) -> DataFrame:
    """The plan of a group of tables; days (one column, a row per row of the lead table) get a label if they have none."""
    known = lake.current("bronze.layout") if "bronze.layout" in lake.pending or lake.has("bronze.layout") else None
    mine = None if known is None else known.filter(F.col("tab") == lead).drop("tab")
    if days is None:
        return mine
    sizes = days.toDF("day").groupBy("day").agg(F.count("*").alias("n"))
    fresh = layout.planned(sizes, mine, lake.target).select(F.lit(lead).alias("tab"), "*")
    every = fresh if known is None else known.unionByName(fresh)
    return lake.write("bronze.layout", every).filter(F.col("tab") == lead).drop("tab")


def write_places(lake: Lake, rows: DataFrame, whole: bool = False) -> None:
    """Add a run to the index; `whole` replaces it. Many runs are folded into one."""
    name = "bronze.places"
    runs = lake.partitions(name)
    run = f"{max(map(int, runs), default=0) + 1:010d}"
    rows = rows.select(ENTITY, "tab", "parts").withColumn("_run", F.lit(run))
    folded = not whole and len(runs) >= FOLD
    if folded:
        every = places.current(lake.table(name).unionByName(rows)).filter(F.size("parts") > 0)
        rows = every.withColumn("_run", F.lit(run))
    lake.write_partitions(name, rows, "_run", runs if whole or folded else [], dealt=True)


def places_of(lake: Lake, wanted: DataFrame | None = None, tabs: list[str] | None = None) -> DataFrame:
    return places.current(lake.current("bronze.places"), wanted, tabs)


def _replace_slice(lake: Lake, table: str, rows: DataFrame, moment: str, since: str, until: str) -> tuple[DataFrame, DataFrame | None, list[str]]:
    """Bronze rows with `_part` in the place of the interval's. Returns what was written, what gave way, and which partitions.

    Rows that the feed brings from outside the interval, or without a time, are merged into their partitions: there they
    take the place of equal documents, nothing else.
    """
    if not lake.has(table):
        return lake.write_partitions(table, rows, "_part", []), None, []
    old = lake.table(table)
    inside = F.coalesce(in_range(F.col(moment), *[F.lit(d).cast(old.schema[moment].dataType) for d in (since, until)]), F.lit(False))
    stray = rows.filter(~inside)
    theirs = [r[0] for r in stray.select("_part").distinct().collect()]  # partitions
    touched = sorted({*layout.within(lake.partitions(table), since, until), *theirs})
    old = old.filter(F.col("_part").isin(touched))
    stays, gone = old.filter(~inside), old.filter(inside)
    if theirs:
        same = stray.select(F.md5("payload").alias("_content"))
        stays = stays.withColumn("_content", F.md5("payload"))
        gone = gone.unionByName(semi_join(stays, ["_content"], same).drop("_content"))
        stays = anti_join(stays, ["_content"], same).drop("_content")
    written = lake.write_partitions(table, stays.unionByName(rows), "_part", touched)
    return written, gone, sorted({*touched, *lake.pending[table].written})


def land(lake: Lake, feeds: dict[str, DataFrame], since: str, until: str, loads: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """Replace the interval in bronze: orders by their update time, rates by day, the rest by load id.

    Orders lie by days as `layout` plans them, rates by month; a run rewrites the partitions its interval is in, and those
    of rows that come from outside it. What that adds, changes and removes goes to `bronze.changed_orders`.

    `feeds` has the bronze rows of the interval; a feed that is missing that day is left out. `loads` names the load ids
    that a feed replaces: one that comes without rows is emptied. (Where it is not given, the ids in the rows.) Order and
    rate documents that are no JSON go to `quarantine.records`, with the feed `records` (lines found broken at landing).
    Returns the rows landed; nothing is published.
    """
    loads = loads or {}
    found, diffs, moved = {}, [], {}
    records = [feeds["records"]] if "records" in feeds else []
    for name, rows in feeds.items():
        table = BRONZE.get(name, f"bronze.{name}")
        gone = None
        if name == "orders":
            rows = rows.withColumn(ENTITY, places.entity("_order_id"))
            plan = plan_of(lake, table, rows.select(layout.day_of("_updated_at")))
            rows = layout.placed(rows, plan, layout.day_of("_updated_at"), F.col(ENTITY))
            written, gone, parts = _replace_slice(lake, table, rows, "_updated_at", since, until)
        elif name == "fx_rates":
            rows = rows.withColumn("_part", F.coalesce(F.left("rate_date", F.lit(7)), F.lit(NONE)))
            _replace_slice(lake, table, rows, "rate_date", since, until)
        elif name != "records":
            parts = loads.get(name) or [r[0] for r in rows.select("_load_id").distinct().collect()]
            if name == "events":
                rows = landed.promoted_events(rows).withColumn(ENTITY, places.entity("_order_id", "_event_id"))
                gone = lake.table(table).filter(F.col("_load_id").isin(parts)) if lake.has(table) else None
            if name == "customers":
                _note_snapshots(lake, rows, parts)
            written = lake.write_partitions(table, rows, "_load_id", parts)
        if name in ("orders", "fx_rates"):
            records.append(landed.unreadable_documents(rows))
        found[name] = rows if name in ("orders", "fx_rates") else written
        if name in ("orders", "events"):
            new = rows if name == "orders" else written  # events as written: their ids are read already
            old = new.limit(0) if gone is None else gone
            diffs.append(version_diff(old, new, [ENTITY], digest("payload")).select(ENTITY, "change"))
            moved[table] = (written, parts)
    if records:
        lake.write_partitions("quarantine.records", reduce(DataFrame.unionByName, records), "_load_id", sorted(loads.get("records", [])))
    if diffs:
        _note_changes(lake, reduce(DataFrame.unionByName, diffs), moved)
    return found


def _snapshot_part() -> Column:
    return F.coalesce(F.col("snapshot_date").cast("string"), F.lit(NONE)).alias("_part")


def _note_snapshots(lake: Lake, rows: DataFrame, load_ids: list[str]) -> None:
    """The days whose customer snapshot comes or gives way wait to be modelled."""
    days = rows.select(_snapshot_part())
    if lake.has("bronze.customers"):
        days = days.union(lake.table("bronze.customers").filter(F.col("_load_id").isin(load_ids)).select(_snapshot_part()))
    if lake.has("bronze.changed_snapshots"):
        days = days.union(lake.table("bronze.changed_snapshots"))
    lake.write("bronze.changed_snapshots", days.distinct())


def _note_changes(lake: Lake, diff: DataFrame, moved: dict[str, tuple[DataFrame, list[str]]]) -> None:
    """Changed orders join those that wait to be modelled, and the index learns where their documents lie now."""
    waiting = lake.table("bronze.changed_orders") if lake.has("bronze.changed_orders") else None
    changed = changed_keys(diff if waiting is None else diff.unionByName(waiting), [ENTITY])
    changed = lake.write("bronze.changed_orders", changed)
    key = {"bronze.orders": "_part", "bronze.events": "_load_id"}
    first = not lake.has("bronze.places")
    before = None if first else places_of(lake, changed, list(moved))
    delta = []
    for table, (written, parts) in moved.items():
        now = places.of_rows(written if first else semi_join(written, [ENTITY], changed), table, F.col(ENTITY), F.col(key[table]))
        delta.append(now if first else places.after_rewrite(before, now, table, parts))
    write_places(lake, reduce(DataFrame.unionByName, delta), whole=first)


def bronze_checks(written: dict[str, DataFrame], tables: list[str], now, lake: Lake) -> DataFrame:
    """The declared checks on what the run landed; on the whole table where it landed nothing."""
    checks = [quality.not_empty(), quality.fresh("_ingested_at", now)]

    def rows(name: str) -> DataFrame:
        new = written.get(name)
        return new if new is not None and new.limit(1).count() else lake.current(f"bronze.{name}")

    return quality.all_results([quality.run_row_checks(f"bronze.{t}", rows(t), checks) for t in tables])


def rows_of(lake: Lake, name: str, touched: DataFrame, where: DataFrame, key: str = "_part") -> DataFrame:
    """Every row of the touched entities; only the partitions that hold them are read."""
    rows = lake.current(name).filter(F.col(key).isin(places.partitions(where, name)))
    return semi_join(rows.withColumn(ENTITY, _entity_of(name)), [ENTITY], touched)


def replace_orders(lake: Lake, name: str, fresh: DataFrame, touched: DataFrame | None, where: DataFrame | None) -> DataFrame:
    """Give the touched orders their fresh rows, in the partitions that hold their old or new ones; None replaces all."""
    if touched is None or not lake.has(name):
        return lake.write_partitions(name, fresh, "_part", lake.partitions(name))
    parts = {r[0] for r in fresh.select("_part").distinct().collect()} | set(places.partitions(where, name))  # partitions
    old = lake.table(name)
    mine = old.filter(F.col("_part").isin(sorted(parts))).withColumn(ENTITY, _entity_of(name))
    stays = anti_join(mine, [ENTITY], touched).select(*old.columns)
    return lake.write_partitions(name, stays.unionByName(fresh), "_part", sorted(parts))


def note_places(lake: Lake, tables: tuple[str, ...], touched: DataFrame | None, where: DataFrame | None) -> None:
    """Tell the index where the rows just written lie; `where` has the places of the touched entities before."""
    now = []
    for name in tables:
        rows = lake.pending[name].rows.withColumn(ENTITY, _entity_of(name))
        rows = rows if touched is None else semi_join(rows, [ENTITY], touched)
        now.append((rows, name, F.col(ENTITY), F.col("_part")))
    if touched is not None:
        write_places(lake, places.replaced(reduce(DataFrame.unionByName, [places.raw(*x) for x in now]), where, list(tables)))
    elif tables == GOLD:
        write_places(lake, reduce(DataFrame.unionByName, [places.of_rows(*x) for x in now]))
    else:  # everything is built: the index as well
        now += [(lake.current(t), t, F.col(ENTITY), F.col(k)) for t, k in (("bronze.orders", "_part"), ("bronze.events", "_load_id"))]
        write_places(lake, reduce(DataFrame.unionByName, [places.of_rows(*x) for x in now]), whole=True)


def newest_events(events: DataFrame) -> DataFrame:
    """Of events that come under one id with different content, the document received last; copies of it stay."""
    content, newest = F.md5("payload"), F.struct("_ingested_at", "_record_id")
    named = events.filter("coalesce(_event_id, '') <> ''").withColumn("_content", content)
    last = named.groupBy("_event_id").agg(F.max_by("_content", newest).alias("_content"))
    return semi_join(named, ["_event_id", "_content"], last).drop("_content").unionByName(events.filter("coalesce(_event_id, '') = ''"))


def judged_anew(lake: Lake, column: str, old: DataFrame, new: DataFrame, reason: str) -> DataFrame:
    """Orders whose lines may be judged otherwise now: rejected for a reference that came, or accepted with one that went."""
    old, new = (r.select(column).distinct() for r in (old, new))
    came, went = anti_join(new, [column], old), anti_join(old, [column], new)
    rejects = lake.table("quarantine.order_lines").filter(F.col("reason_code") == reason)
    rejects = rejects.withColumn(column, F.get_json_object("payload", f"$.{column}"))
    return semi_join(rejects, [column], came).select(ENTITY).union(
        semi_join(lake.table("silver.order_lines"), [column], went).select(places.entity().alias(ENTITY))
    )


def build_silver(lake: Lake, some: bool = True, landed_now: tuple[str, ...] = ()) -> bool:
    """Stage, write accepted and rejected rows and check them; the caller publishes.

    With `some`, only the orders of `bronze.changed_orders` are staged anew, from all their documents and events, and
    replaced in the partitions that hold them; orders that are gone from bronze leave every table. Otherwise everything is
    built. Customers and products are snapshots and built whole, if they came or are not there yet (`landed_now`).
    Returns whether only some orders were touched.
    """
    some = some and all(map(lake.has, ("silver.order_lines", "bronze.places", "bronze.changed_orders")))
    bronze = {t: lake.current(f"bronze.{t}") for t in ("orders", "customers", "products", "events")}
    by_day = some and lake.has("bronze.changed_snapshots") and lake.has("silver.known_customers")
    if by_day:
        by_day = all("_part" in lake.table(f"silver.{t}").columns for t in ("customers", "known_customers"))
    days = [r[0] for r in lake.table("bronze.changed_snapshots").collect()] if by_day else []  # snapshots that came
    held = {k: lake.table(f"silver.known_{k}s") for k in ("customer", "product") if lake.has(f"silver.known_{k}s")}
    snapshots = bronze["customers"].withColumn("_part", _snapshot_part())
    snapshots = snapshots.filter(F.col("_part").isin(days)) if by_day else snapshots
    replace_days(lake, "silver.known_customers", snapshots.select("customer_id", "_part").distinct(), days, by_day)
    products = not some or "products" in landed_now or not lake.has("silver.known_products")
    if products:
        lake.write("silver.known_products", bronze["products"].select("product_id").distinct())
    fresh = ["customer"] * bool(by_day and days) + ["product"] * bool(some and products and "product" in held)
    if fresh:
        judged = [judged_anew(lake, f"{k}_id", held[k], lake.current(f"silver.known_{k}s"), f"unknown_{k}") for k in fresh]
        waiting = lake.table("bronze.changed_orders").unionByName(reduce(DataFrame.unionByName, judged).withColumn("change", F.lit("changed")))
        lake.write("bronze.changed_orders", waiting.groupBy(ENTITY).agg(F.min("change").alias("change")))
    touched = where = None
    orders, events, known = bronze["orders"], bronze["events"], bronze["orders"]
    if some:
        touched = lake.current("bronze.changed_orders").select(ENTITY)
        where = lake.write("silver.touched_places", places_of(lake, touched, ["bronze.orders", "bronze.events", *SILVER]))
        orders = rows_of(lake, "bronze.orders", touched, where)
        events = rows_of(lake, "bronze.events", touched, where, "_load_id")
        known = places.known(where, "bronze.orders").withColumnRenamed(ENTITY, "_order_id")
    staged = {
        "silver.stg_order_lines": staging.order_lines(orders, lake.current("silver.known_customers"), lake.current("silver.known_products")),
        "silver.stg_order_events": staging.order_events(newest_events(events), known),
    }
    if days or not by_day:
        staged["silver.stg_customers"] = staging.customers(snapshots)
    if products:
        staged["silver.stg_products"] = staging.products(bronze["products"])
    staged = lake.write_all(staged)
    lines, events = staged["silver.stg_order_lines"], staged["silver.stg_order_events"]

    good, bad = silver.status_history(events), silver.status_history_rejected(events)
    field = lambda name: F.get_json_object("payload", f"$.{name}")
    plan = plan_of(lake, "silver.order_status_history", events.select(layout.day_of("event_ts")))
    good = layout.placed(good, plan, layout.day_of("event_ts"), places.entity())
    bad = bad.withColumn(ENTITY, places.entity(field("order_id"), field("event_id"))).withColumn("_at", field("event_ts").cast("timestamp"))
    bad = layout.placed(bad, plan, layout.day_of("_at"), F.col(ENTITY)).drop("_at")
    history = replace_orders(lake, "silver.order_status_history", good, touched, where)
    replace_orders(lake, "quarantine.order_events", bad, touched, where)

    plan = plan_of(lake, "silver.order_lines", lines.select(layout.day_of("order_ts")))
    rejects = silver.order_lines_rejected(lines).withColumn("order_id", field("order_id")).withColumn(ENTITY, places.entity())
    rejects = rejects.withColumn("_at", field("order_ts").cast("timestamp"))
    accepted = layout.placed(silver.order_lines(lines), plan, layout.day_of("order_ts"), places.entity())
    order_lines = replace_orders(lake, "silver.order_lines", accepted, touched, where)
    rejects = layout.placed(rejects, plan, layout.day_of("_at"), F.col(ENTITY)).drop("_at")
    replace_orders(lake, "quarantine.order_lines", rejects, touched, where)
    times = lines.groupBy("order_id").agg(F.min("order_ts").alias("_at"))
    status = keyed_join(silver.status_reconciliation(lines, silver.status_history(events)), times, ["order_id"])
    status = layout.placed(status, plan, layout.day_of("_at"), places.entity()).drop("_at")
    replace_orders(lake, "silver.order_status_reconciliation", status, touched, where)
    note_places(lake, SILVER, touched, where)
    if "silver.stg_customers" in staged:
        found = staged["silver.stg_customers"]
        rejects = silver.customers_rejected(found).withColumn("snapshot_date", F.get_json_object("payload", "$.snapshot_date"))
        replace_days(lake, "silver.customers", silver.customers(found).withColumn("_part", _snapshot_part()), days, by_day)
        replace_days(lake, "quarantine.customers", rejects.withColumn("_part", _snapshot_part()).drop("snapshot_date"), days, by_day)
    if products:
        found = staged["silver.stg_products"]
        lake.write_all({"silver.products": silver.products(found), "quarantine.products": silver.products_rejected(found)})
    clean_customers = lake.pending["silver.customers"].rows if "silver.customers" in lake.pending else lake.table("silver.customers").limit(0)
    clean_products = lake.current("silver.products")

    not_null, one_of = quality.not_null, quality.accepted_values
    line_keys = ["order_id", "line_number"]
    lake.check(
        quality.all_results(
            [
                quality.run_row_checks(
                    "silver.order_lines",
                    order_lines,
                    [not_null(c) for c in (*line_keys, "customer_id", "product_id")] + [one_of("currency", CURRENCIES)],
                ),
                quality.unique("silver.order_lines", order_lines, line_keys),
                quality.run_row_checks(
                    "silver.customers", clean_customers, [not_null("customer_id"), not_null("snapshot_date")]
                ),
                quality.run_row_checks(
                    "silver.products", clean_products, [not_null("product_id"), one_of("currency", CURRENCIES)]
                ),
                quality.unique("silver.products", clean_products, ["product_id"]),
                quality.run_row_checks(
                    "silver.order_status_history", history, [not_null("event_id"), not_null("order_id")]
                ),
                quality.unique("silver.order_status_history", history, ["event_id"]),
            ]
        )
    )
    return some


def replace_days(lake: Lake, name: str, rows: DataFrame, days: list[str], by_day: bool) -> None:
    """Snapshot rows in the place of those of some days; else of all, also where the table has no days yet."""
    if by_day and not days:
        return
    old_form = lake.has(name) and "_part" not in lake.table(name).columns
    lake.write_partitions(name, rows, "_part", days if by_day else [] if old_form else lake.partitions(name))
    lake.pending[name].anew = old_form


def build_customers(lake: Lake, some: bool) -> tuple[DataFrame | None, str | None]:
    """Bring `gold.dim_customer` up to date, writing only buckets with a customer that changed.

    Returns those customers (None: any) and the day from which their versions may differ (None: ever).
    """
    name, now = "gold.dim_customer", [p for p in lake.partitions("silver.customers") if p != NONE]
    bucketed = lake.has(name) and "_bucket" in lake.table(name).columns
    bucket = F.pmod(F.xxhash64("customer_id"), F.lit(BUCKETS)).cast("string").alias("_bucket")
    days = sorted(r[0] for r in lake.table("bronze.changed_snapshots").filter(F.col("_part") != NONE).collect())  # snapshots that came
    series = sorted(r[0] for r in lake.table("gold.customer_days").collect()) if lake.has("gold.customer_days") else []
    days = [d for d in days if d in series or d in now]
    lake.write("gold.customer_days", lake.spark.createDataFrame([(d,) for d in now], "day string"))
    lake.write("bronze.changed_snapshots", lake.table("bronze.changed_snapshots").limit(0))
    if not some or not bucketed or not series or len(days) > MERGED_DAYS or sorted({*series, *days} - ({*days} - {*now})) != now:
        dimension = gold.dim_customer(lake.table("silver.customers")).withColumn("_bucket", bucket)
        lake.write_partitions(name, dimension, "_bucket", lake.partitions(name) if bucketed else [])
        lake.pending[name].anew = lake.has(name) and not bucketed
        return None, None
    dimension, changed = lake.table(name).drop("_bucket"), None
    since = days[0] if days and days[0] > series[0] else None
    for day in days:
        present = day in now
        keys, fresh = gold.merge_customers(dimension, series, lake.table("silver.customers").filter(F.col("_part") == day), day, present)
        keys = lake.write("gold.changed_customers", keys if changed is None else keys.union(changed).distinct())
        fresh = lake.write("gold.fresh_customers", fresh)
        dimension, changed, series = anti_join(dimension, ["customer_id"], keys).unionByName(fresh), keys, merged_series(series, day, present)
        if len(days) > 1:
            dimension = lake.write("gold.merged_customers", dimension)
    if changed is None:
        return lake.spark.createDataFrame([], "customer_id string"), None
    buckets = [r[0] for r in changed.select(bucket).distinct().collect()]
    if buckets:
        rows = dimension.withColumn("_bucket", bucket).filter(F.col("_bucket").isin(buckets))
        lake.write_partitions(name, rows, "_bucket", buckets)
    return changed, since


def _edge_days(lake: Lake, name: str, moment: str) -> DataFrame:
    """Local days of a table's first and last month of partitions: its first and last day are among them."""
    labels = [p for p in lake.partitions(name) if p != NONE]
    ends = {min(labels)[:7], max(labels)[:7]} if labels else set()
    rows = lake.table(name).filter(F.col("_part").isin([p for p in labels if p[:7] in ends]))
    return rows.select(local_date(F.col(moment)).alias("day"))


def refresh_revenue(lake: Lake, some: bool) -> None:
    """Bring `gold.monthly_revenue` up to date: with `some`, only the months whose lines were written."""
    name, change = "gold.monthly_revenue", lake.pending["gold.fct_order_lines"]
    fact = lake.current("gold.fct_order_lines")
    some = some and lake.has(name)
    months = sorted({p[:7] for p in (*change.touched, *change.written) if p != NONE})
    if some:
        fact = fact.filter(F.left("_part", F.lit(7)).isin(months))
    rows = reports.monthly_revenue(fact, *[lake.current(f"gold.dim_{d}") for d in ("date", "product", "customer")])
    lake.write_partitions(name, rows.withColumn("_month", F.date_format("month", "yyyy-MM")), "_month", months if some else lake.partitions(name))


def compact(lake: Lake, name: str, key: str = "_part", files: int = 4, target: int = 64 << 20) -> list[str]:
    """Rewrite the partitions of a published table that lie in more than `files` files and need fewer; returns them.

    Files are counted from their own names and sizes, without reading a column; files of `target` bytes or more are enough. The rewrite makes
    files of Spark's advisory size.
    """
    held = lake.table(name).select(key, "_metadata.file_path", "_metadata.file_size").distinct()
    held = held.groupBy(key).agg(F.count("*").alias("n"), F.sum("file_size").alias("size"))
    crowded = sorted(r[key] for r in held.filter((F.col("n") > files) & (F.col("n") > 2 * F.col("size") / target)).collect())
    if crowded:
        lake.write_partitions(name, lake.table(name).filter(F.col(key).isin(crowded)), key, crowded)
        lake.publish()
    return crowded


def build_gold(lake: Lake, some: bool, calendar: tuple[str, str] | None = None, priced: bool = True, newer_products: bool = True) -> dict[str, tuple[str, ...]]:
    """Dimensions and facts, checked before they are published. `priced` also asks for an amount on every line.

    With `some`, facts are built for the orders of `bronze.changed_orders`, which is empty afterwards. The calendar spans
    the data unless its first and last day are given.
    """
    lines, history = lake.table("silver.order_lines"), lake.table("silver.order_status_history")
    if calendar is None:
        edges = [_edge_days(lake, "silver.order_lines", "order_ts"), _edge_days(lake, "silver.order_status_history", "event_ts")]
        dates = gold.dim_date(gold.day_bounds(*edges))
    else:
        dates = gold.calendar(lake.spark, *calendar)
    dates = lake.write("gold.dim_date", dates)
    changed, since = build_customers(lake, some)
    if not some or not lake.has("gold.dim_product") or newer_products:
        lake.write("gold.dim_product", gold.dim_product(lake.table("silver.stg_products")))
    customers, products = lake.current("gold.dim_customer"), lake.current("gold.dim_product")
    status = lake.table("silver.order_status_reconciliation")
    touched = where = None
    if some:
        touched = lake.table("bronze.changed_orders").select(ENTITY)
        if changed is None or "gold.changed_customers" in lake.pending:  # their orders may belong to another version now
            theirs = lines if since is None else lines.filter((F.col("_day") >= F.date_sub(F.lit(since).cast("date"), 1).cast("string")) | (F.col("_day") == NONE))
            theirs = theirs if changed is None else semi_join(theirs, ["customer_id"], changed)
            touched = touched.union(theirs.select(places.entity().alias(ENTITY))).distinct()
        touched = lake.write("gold.touched_orders", touched)
        read = ["silver.order_lines", "silver.order_status_history", "silver.order_status_reconciliation"]
        where = lake.write("silver.touched_places", places_of(lake, touched, [*read, *GOLD]))
        lines, history, status = (rows_of(lake, n, touched, where) for n in read)
    fact = gold.fct_order_lines(lines, gold.fx_rates(lake.table("bronze.fx_rates")), status, dates, customers)
    day = F.coalesce(F.col("order_date_baku").cast("string"), F.lit(NONE))
    fact = layout.placed(fact, plan_of(lake, "silver.order_lines"), day, places.entity())
    if touched is not None and lake.has("gold.fct_order_lines"):
        mine = fact = lake.write("gold.fresh_lines", fact)
        fact = replace_orders(lake, "gold.fct_order_lines", fact, touched, where)
    else:  # all of it is fresh
        mine = fact = replace_orders(lake, "gold.fct_order_lines", fact, touched, where)
    name = "gold.fct_order_status_events"
    day = F.coalesce(F.col("event_date_baku").cast("string"), F.lit(NONE))
    events = layout.placed(gold.fct_order_status_events(history, dates), plan_of(lake, "silver.order_status_history"), day, places.entity())
    events = replace_orders(lake, name, events, touched, where)
    note_places(lake, GOLD, touched, where)
    refresh_revenue(lake, some and not newer_products)
    scratch = [lake.pending.pop(name, None) for name in ("gold.fresh_lines", "gold.fresh_customers", "gold.merged_customers")]
    lake.write("bronze.changed_orders", lake.table("bronze.changed_orders").limit(0))
    changed_rows = lake.pending["gold.dim_customer"].rows if "gold.dim_customer" in lake.pending else customers.limit(0)
    not_null = quality.not_null
    fact_checks = [not_null("order_id"), not_null("line_number")] + ([not_null("gross_amount_azn")] if priced else [])
    lake.check(
        quality.all_results(
            [
                quality.run_row_checks("gold.dim_date", dates, [not_null("date_key")]),
                quality.unique("gold.dim_date", dates, ["date_key"]),
                quality.run_row_checks("gold.dim_product", products, [not_null("product_id")]),
                quality.unique("gold.dim_product", products, ["product_id"]),
                quality.run_row_checks("gold.dim_customer", changed_rows, [not_null("customer_key"), not_null("customer_id")]),
                quality.unique("gold.dim_customer", changed_rows, ["customer_key"]),
                quality.run_row_checks("gold.fct_order_lines", fact, fact_checks),
                quality.relationship("gold.fct_order_lines", fact, "product_id", products, "product_id"),
                quality.relationship("gold.fct_order_lines", fact, "customer_key", customers, "customer_key"),
                quality.relationship("gold.fct_order_lines", fact, "order_date_key", dates, "date_key"),
                # Untouched orders were counted by the run that wrote them.
                quality.same_count("gold.fct_order_lines", "grain", mine.filter("order_id IS NOT NULL"), lines.filter("order_id IS NOT NULL")),
                quality.run_row_checks(name, events, [not_null("event_id")]),
                quality.unique(name, events, ["event_id"]),
            ]
        )
    )
    moved = lake.publish()
    for change in filter(None, scratch):
        remove(lake.spark, change.path)
    return moved


def run_interval(
    lake: Lake,
    feeds: dict[str, DataFrame],
    since: str,
    until: str,
    now,
    calendar: tuple[str, str] | None = None,
    full_refresh: bool = False,
    priced: bool = True,
    checked: tuple[str, ...] = ("orders", "products", "fx_rates"),
    loads: dict[str, list[str]] | None = None,
) -> dict[str, tuple[str, ...]]:
    """Land `[since, until)`, then bring silver and gold up to date; returns the partitions each table had rewritten.

    Every layer is checked before it is published; a failed check stops the run and leaves nothing of its layer behind.
    """
    moved: dict[str, tuple[str, ...]] = {}
    written = land(lake, feeds, since, until, loads)
    lake.check(bronze_checks(written, list(checked), now, lake))
    moved |= lake.publish()
    some = build_silver(lake, not full_refresh, tuple(written))
    moved |= lake.publish()
    moved |= build_gold(lake, some, calendar, priced, "products" in written)
    return moved


def rearrange(lake: Lake) -> dict[str, tuple[str, ...]]:
    """Plan the partitions of all tables anew by what they hold, and move the rows whose partition changes.

    Split days that grew heavy, group days that are light. A table that still lies by `_month`, from before days were
    planned, is brought to the present layout whole. Only partitions that rows leave or join are rewritten.
    """
    months = [t for t in (*PARTED, "bronze.fx_rates") if lake.has(t) and "_month" in lake.table(t).columns]
    events = lake.table("bronze.events")
    if ENTITY not in events.columns:
        rows = landed.promoted_events(events).withColumn(ENTITY, places.entity("_order_id", "_event_id"))
        lake.write_partitions("bronze.events", rows.select(*[c for c in rows.columns if c != "_load_id"], "_load_id"), "_load_id", [])
        lake.pending["bronze.events"].anew = True
    plans = []
    for lead, tables in PLANS.items():
        held = {t: lake.table(t) for t in tables if lake.has(t)}
        for t, rows in held.items():
            if t in months:
                held[t] = rows.withColumn("_day", _old_day(t))
            if t in WITH_ENTITY and ENTITY not in rows.columns:
                held[t] = held[t].withColumn(ENTITY, _old_entity(t))
        plan = layout.planned(held[lead].groupBy(F.col("_day").alias("day")).agg(F.count("*").alias("n")), None, lake.target)
        plans.append(plan.select(F.lit(lead).alias("tab"), "*"))
        for t, rows in held.items():
            as_is = rows.withColumnRenamed("_month" if t in months else "_part", "_was")
            now = layout.placed(as_is.withColumnRenamed("_day", "_on"), plan, F.col("_on"), _entity_of(t)).drop("_on")
            if t in months:
                lake.write_partitions(t, now.drop("_was"), "_part", [])
                lake.pending[t].anew = True
                continue
            pairs = now.filter("_was <> _part").select("_was", "_part").distinct().collect()  # partitions
            touched = sorted({p for pair in pairs for p in pair})
            if touched:
                lake.write_partitions(t, now.filter(F.col("_was").isin(touched)).drop("_was"), "_part", touched)
    if "bronze.fx_rates" in months:
        lake.write_partitions("bronze.fx_rates", lake.table("bronze.fx_rates").withColumnRenamed("_month", "_part"), "_part", [])
        lake.pending["bronze.fx_rates"].anew = True
    lake.write("bronze.layout", reduce(DataFrame.unionByName, plans))
    index = [places.of_rows(lake.current(t).withColumn(ENTITY, _entity_of(t)), t, F.col(ENTITY), F.col("_part")) for t in PARTED if lake.has(t)]
    index.append(places.of_rows(lake.current("bronze.events"), "bronze.events", F.col(ENTITY), F.col("_load_id")))
    write_places(lake, reduce(DataFrame.unionByName, index), whole=True)
    if not lake.has("bronze.changed_orders"):
        lake.write("bronze.changed_orders", lake.spark.createDataFrame([], f"{ENTITY} string, change string"))
    return lake.publish()


def _old_day(name: str) -> Column:
    """The day of a row of a table that lay by month, from its own columns; its month's first day where it has none."""
    moments = {
        "bronze.orders": F.col("_updated_at"), "silver.order_lines": F.col("order_ts"), "silver.order_status_history": F.col("event_ts"),
        "quarantine.order_lines": F.get_json_object("payload", "$.order_ts").cast("timestamp"), "quarantine.order_events": F.get_json_object("payload", "$.event_ts").cast("timestamp"),
        "gold.fct_order_lines": F.col("order_date_baku"), "gold.fct_order_status_events": F.col("event_date_baku"),
    }
    first = F.when(F.col("_month") != NONE, F.concat("_month", F.lit("-01"))).otherwise(NONE)
    return F.coalesce(F.date_format(moments[name], "yyyy-MM-dd"), F.lit(NONE)) if name in moments else first


def _old_entity(name: str) -> Column:
    if name == "bronze.orders":
        return places.entity("_order_id")
    field = lambda f: F.get_json_object("payload", f"$.{f}")
    return places.entity(field("order_id"), field("event_id") if name == "quarantine.order_events" else None)


def backfill(lake: Lake, feeds_of, days: list[tuple[str, str]], now, **options) -> None:
    """Run intervals in order; `feeds_of(since, until)` gives the feeds of one."""
    for since, until in days:
        run_interval(lake, feeds_of(since, until), since, until, now, **options)


def table_counts(lake: Lake, names: list[str]) -> DataFrame:
    counts = [
        lake.table(n).agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n in names
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result
