"""Table publishing, load replacement, partition layout, compaction and CSV export."""

import json
import re
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.operators.upsert import replace_range
from bazaar.session import CODEC, remove

LAYERS = ("bronze", "silver", "gold", "quarantine")


def create_layers(spark: SparkSession, root: str, prefix: str = "") -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer} LOCATION '{root}/{layer}'")


def write_version(df: DataFrame, root: str, table: str) -> str:
    """Write to a folder of its own and return it; nothing that is being read is overwritten."""
    path = f"{root}/{table.replace('.', '/')}/v-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("compression", CODEC).parquet(path)
    return path


def publish(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Point the catalog table at a finished version: readers see the old one or the new one, never a mix."""
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
    else:
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")
    return spark.table(table)


def _escaped(spark: SparkSession, value: str) -> str:
    """A partition value as Spark writes it in folder names."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish_partitions(
    spark: SparkSession, table: str, key: str, path: str, touched: tuple[str, ...], written: tuple[str, ...]
) -> None:
    """Point partitions at the folders of a version; touched ones that have no rows any more go."""
    there = {unquote(r[0].split("=", 1)[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    place = lambda v: f"PARTITION (`{key}`={_literal(v)})"
    where = lambda v: _literal(f"{path}/{key}={_escaped(spark, v)}")
    new = [v for v in written if v not in there]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD " + " ".join(f"{place(v)} LOCATION {where(v)}" for v in new))
    for value in set(written) & there:
        spark.sql(f"ALTER TABLE {table} {place(value)} SET LOCATION {where(value)}")
    for value in set(touched) - set(written):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {place(value)}")
    spark.catalog.refreshTable(table)


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def write_journal(spark: SparkSession, root: str, moves: list[dict]) -> str:
    """Note what a publish is about to do, as one file that is there whole or not at all."""
    name = f"{root}/_journal/{uuid.uuid4().hex}"
    draft, fs = _file_system(spark, name + ".draft")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(moves).encode()))
    out.close()
    fs.rename(draft, spark._jvm.org.apache.hadoop.fs.Path(name + ".json"))
    return name + ".json"


def journals(spark: SparkSession, root: str) -> dict[str, list[dict]]:
    """Notes of publishes that did not end, with what they were about to do; at most a few."""
    where, fs = _file_system(spark, f"{root}/_journal")
    names = [s.getPath().toString() for s in (fs.listStatus(where) if fs.exists(where) else [])]
    read = lambda n: spark.read.option("wholetext", True).text(n).first()["value"]
    return {n: json.loads(read(n)) for n in sorted(names) if n.endswith(".json")}


def locations(spark: SparkSession, table: str) -> set[str]:
    """Folders that a table's data lies in."""
    def found(sql: str) -> set[str]:
        return {r["data_type"] for r in spark.sql(sql).collect() if r["col_name"].strip(":") == "Location"}

    out = found(f"DESCRIBE EXTENDED {table}")
    keys = [r["col_name"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()]
    if "# Partition Information" in keys:
        for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
            key, value = row[0].split("=", 1)
            out |= found(f"DESCRIBE EXTENDED {table} PARTITION (`{key}`={_literal(unquote(value))})")
    return out


def drop_versions(spark: SparkSession, folder: str, live: set[str]) -> int:
    """Delete what no live location is in: version folders, and partition folders of versions that others of are live."""
    where, fs = _file_system(spark, folder)
    plain = {re.sub("^[a-z0-9]+:/+", "/", place).rstrip("/") for place in live}
    listed = lambda p: [s.getPath() for s in fs.listStatus(p)]
    old = []
    for version in [p for p in (listed(where) if fs.exists(where) else []) if p.getName().startswith("v-")]:
        mine = {place.split(f"/{version.getName()}", 1)[1].strip("/") for place in plain if f"/{version.getName()}" in place}
        if not mine:
            old.append(version)
        elif "" not in mine:
            old += [p for p in listed(version) if "=" in p.getName() and p.getName() not in mine]
    for path in old:
        fs.delete(path, True)
    return len(old)


def replace_loads(df: DataFrame, path: str, load_ids: list[str]) -> None:
    """The loads named in `load_ids` become the rows of `df`; a load without rows is emptied, other loads stay."""
    spark = df.sparkSession
    mine = df.filter(F.col("_load_id").isin(*load_ids))
    mine.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_load_id").parquet(path)
    written = {r["_load_id"] for r in mine.select("_load_id").distinct().collect()}  # some of the ids given
    for load_id in set(load_ids) - written:
        remove(spark, f"{path}/_load_id={_escaped(spark, load_id)}")


def replaced_slice(target: DataFrame, batch: DataFrame, source: str, column: Column, low, high) -> DataFrame:
    """Reprocess one source and time slice: its rows in `[low, high)` give way to the batch, others stay."""
    mine = F.col("_source") == source
    return target.filter(~mine).unionByName(replace_range(target.filter(mine), batch, column, low, high))


def write_by_month(df: DataFrame, day: str, path: str, month: str = "order_month") -> None:
    """Month partitions. Writers are spread over month and a hash of the row, so a hot month is many files."""
    spread = df.withColumn(month, F.date_format(day, "yyyy-MM"))
    spread.hint("rebalance", month).write.mode("overwrite").partitionBy(month).parquet(path)


def compact(spark: SparkSession, path: str, out: str, partition_by: list[str] | None = None) -> DataFrame:
    """Rewrite small files into files of the advisory size, keeping the partition folders."""
    rows = spark.read.parquet(path)
    keys = partition_by or []
    writer = (rows.hint("rebalance", *keys) if keys else rows.hint("rebalance")).write.mode("errorifexists")
    (writer.partitionBy(*keys) if keys else writer).parquet(out)
    return spark.read.parquet(out)


def export_csv(df: DataFrame, path: str) -> None:
    """Report as CSV with a header, in the frame's order."""
    df.write.mode("overwrite").option("header", True).csv(path)
