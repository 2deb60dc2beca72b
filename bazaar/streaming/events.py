"""Status events as a stream of landed lines."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaar.plans.staging import STATUS_EVENT
from bazaar.schemas import EVENT_DOC
from bazaar.session import move, remove
from bazaar.sources.landed import exists, is_json, paths
from bazaar.sources.sinks import journals, write_journal


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder).filter(F.trim("value") != "")


def parsed(lines: DataFrame) -> DataFrame:
    """Events of the lines that are JSON; the other lines are `malformed(lines)`."""
    doc = lines.filter(is_json(F.col("value"))).select(F.from_json("value", EVENT_DOC).alias("doc")).select("doc.*")
    return doc.withColumn("event_ts", F.col("event_ts").cast("timestamp")).select(*STATUS_EVENT)


def malformed(lines: DataFrame) -> DataFrame:
    return lines.filter(~is_json(F.col("value")))


DAY = "event_day"
DIGEST = ("_one", "_two")  # 128 bits of an event, over all its fields
MOST_BATCHES = 8  # folders of a day that stay apart


def _landing(path: str, quarantine: str):
    """Each batch: lines that are no JSON to quarantine, events that are not there yet to the table.

    A repeat is equal in every field, as in the batch form; on the id alone, events that lack one would merge. The table
    lies by event day and batch, so a batch lists and reads its own days, however late they are, and of them the digests of
    the events only; there is no watermark behind which events are lost, and no state that grows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        malformed(batch).select(F.col("value").alias("raw")).write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
        found = parsed(batch).distinct().withColumn(DAY, F.coalesce(F.to_date("event_ts").cast("string"), F.lit("none")))
        found = found.withColumns({c: F.xxhash64(F.lit(c), *[F.coalesce(F.col(x).cast("string"), F.lit("\u0000")) for x in STATUS_EVENT]) for c in DIGEST})
        days = [r[DAY] for r in found.select(DAY).distinct().collect()]  # days of one batch
        if there := [f"{path}/{DAY}={d}" for d in days if exists(spark, f"{path}/{DAY}={d}/batch=*")]:
            schema = T.StructType([*[found.schema[c] for c in DIGEST], T.StructField(DAY, T.StringType()), T.StructField("batch", T.LongType())])
            old = spark.read.option("basePath", path).schema(schema).parquet(*there).filter(F.col("batch") != batch_id)
            found = found.join(old.select(*DIGEST), [*DIGEST], "left_anti")
        # Overwriting the batch's own folders makes a replayed batch harmless.
        rows = found.select(*STATUS_EVENT, *DIGEST, DAY, F.lit(batch_id).cast("long").alias("batch"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, "batch").parquet(path)
        batch.unpersist()

    return write


def landed_events(spark: SparkSession, path: str) -> DataFrame:
    """The events that `land_events` has written."""
    return spark.read.option("basePath", path).parquet(f"{path}/{DAY}=*").select(*STATUS_EVENT)


def _finish_merges(spark: SparkSession, path: str) -> None:
    """Do what notes of merges say: the merged folder takes the place of those it was made of."""
    for note, merges in journals(spark, path).items():
        for m in merges:
            if exists(spark, m["merged"]):  # else it is in its place already
                for old in m["gone"]:
                    remove(spark, old)
                move(spark, m["merged"], m["place"])
        remove(spark, note)


def compact_landed(spark: SparkSession, path: str, most: int = MOST_BATCHES) -> list[str]:
    """Merge the batches of days that have more than `most` folders; returns those days. Run it between runs of the stream.

    So files and listings stay in proportion to days, not batches. A merge that stops is ended by the next start of
    either; a batch that comes back after its folder was merged finds its events there.
    """
    _finish_merges(spark, path)
    folders: dict[str, list[str]] = {}
    for place in paths(spark, f"{path}/{DAY}=*/batch=*"):
        folders.setdefault(place.rsplit("/", 1)[0], []).append(place)
    merges = []
    for day, held in folders.items():
        if len(held) <= most:
            continue
        lowest = min(int(p.rsplit("=", 1)[1]) for p in held)
        merged = f"{day}/_merged-{uuid.uuid4().hex}"  # not read while its name begins so
        spark.read.parquet(*held).hint("rebalance").write.parquet(merged)
        merges.append({"merged": merged, "place": f"{day}/batch={min(lowest, 0) - 1}", "gone": held})
    if merges:
        write_journal(spark, path, merges)
        _finish_merges(spark, path)
    return [m["place"].split(f"{DAY}=")[1].split("/")[0] for m in merges]


def land_events(lines: DataFrame, path: str, checkpoint: str, quarantine: str):
    """Run what is there: events once each into `path`, other lines into `quarantine`; returns the finished query."""
    _finish_merges(lines.sparkSession, path)
    query = (
        lines.writeStream.foreachBatch(_landing(path, quarantine))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def latest_status_changes(events: DataFrame) -> DataFrame:
    """Latest status per order by event time, whatever the arrival order."""
    newest = F.max_by(F.struct("event_id", "op", "new_status", "event_ts"), F.struct("event_ts", "event_id"))
    return events.groupBy("order_id").agg(newest.alias("e")).select("order_id", "e.*")


STATUS = "order_id string, event_id string, op string, new_status string, event_ts timestamp"


def _status_sink(path: str, quarantine: str | None):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        if quarantine:
            malformed(batch).select(F.col("value").alias("raw")).write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")
        latest_status_changes(parsed(batch)).write.mode("overwrite").parquet(f"{path}/log/batch={batch_id}")
        batch.unpersist()

    return write


def keep_latest_status(lines: DataFrame, path: str, checkpoint: str, quarantine: str | None = None):
    """Log the latest status of each batch's orders; lines that are no JSON go to `quarantine`, if it is named.

    There is no state in the stream: the latest of a maximum is the same whatever is folded first and how often, so a
    batch that is written again, before or after a fold, changes nothing.
    """
    query = (
        lines.writeStream.foreachBatch(_status_sink(path, quarantine))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _generations(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the snapshots that are whole."""
    return sorted(int(p.split("gen=")[1].split("/")[0]) for p in paths(spark, f"{path}/snapshot/gen=*/_SUCCESS"))


def latest_status(spark: SparkSession, path: str) -> DataFrame:
    """Current status per order, from the newest snapshot and the log; a tombstone shows as op 'd' without a status."""
    parts = [spark.createDataFrame([], STATUS)]
    if found := _generations(spark, path):
        parts.append(spark.read.schema(STATUS).parquet(f"{path}/snapshot/gen={found[-1]}"))
    if exists(spark, f"{path}/log/batch=*"):
        parts.append(spark.read.schema(STATUS).parquet(f"{path}/log/batch=*"))
    return latest_status_changes(reduce(DataFrame.unionByName, parts))


def compact_changes(spark: SparkSession, path: str, keep_tombstones: str | None = None) -> None:
    """Fold snapshot and log into the next generation; run it between runs of the stream.

    Reading then costs the orders plus the batches since. The log and older snapshots go only when the new one is whole; until
    then, and if a folded batch comes back, reading both gives the same. With `keep_tombstones` (an interval such as
    "30 days"), erased orders leave once their tombstone is that much older than the newest event: an event of theirs that
    comes later still would show again.
    """
    found = _generations(spark, path)
    batches = paths(spark, f"{path}/log/batch=*")
    rows = latest_status(spark, path)
    if keep_tombstones:
        newest = rows.agg(F.max("event_ts").alias("t")).scalar()
        gone = (F.col("op") == "d") & (F.col("event_ts") < newest - F.expr(f"interval {keep_tombstones}"))
        rows = rows.filter(~F.coalesce(gone, F.lit(False)))
    rows.write.mode("overwrite").parquet(f"{path}/snapshot/gen={(found[-1] if found else 0) + 1}")
    for old in [*batches, *[f"{path}/snapshot/gen={g}" for g in found]]:
        remove(spark, old)
