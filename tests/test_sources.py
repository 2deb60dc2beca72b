import csv
import json

import pytest
from pyspark.sql import functions as F

from bazaar.sources import landed, sinks


def test_line_numbers_over_many_blocks(spark, conf, tmp_path):
    conf(spark__sql__files__maxPartitionBytes="4KB", spark__sql__files__openCostInBytes="1")
    for name, count in (("order_events_2026-08-24.ndjson", 1500), ("order_events_2026-08-25.ndjson", 7)):
        text = "\n".join("" if n % 10 == 5 else f'  {{"n": {n}}} ' for n in range(1, count + 1))
        (tmp_path / name).write_text(text + "\n")
    rows = landed.event_lines(spark, str(tmp_path)).collect()
    assert len(rows) == 1500 - 150 + 6
    assert all(json.loads(r.value)["n"] == r._line_no for r in rows)
    assert {(r._source_file[-17:-7], r.file_date) for r in rows} == {("2026-08-24", "2026-08-24"), ("2026-08-25", "2026-08-25")}


def test_malformed_lines_go_to_quarantine(spark, tmp_path):
    (tmp_path / "order_events_2026-08-24.ndjson").write_text('{"event_id": "E1"}\n\n{"event_id": "E2", "op\n{"event_id": "E3"}\n')
    events, bad = landed.split_events(landed.event_lines(spark, str(tmp_path)), "b1")
    assert sorted((r._line_no, r._load_id, r._record_id) for r in events.collect()) == [
        (1, "events_2026-08-24", "order_events_2026-08-24.ndjson:1"), (4, "events_2026-08-24", "order_events_2026-08-24.ndjson:4"),
    ]
    (row,) = bad.collect()
    expected = spark.sql("select md5('events_ndjson:events_2026-08-24:3') as id").first().id
    assert (row.quarantine_id, row.reason_code) == (expected, "malformed_json")
    assert json.loads(row.payload) == {"raw": '{"event_id": "E2", "op'}


def test_csv_by_name_with_quotes_and_blanks(spark, tmp_path):
    path = tmp_path / "customers_snapshot_2026-08-24.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        out.writerow(["full_name", "customer_id", "country", "segment", "signup_date", "updated_at", "extra"])
        out.writerow(['Ləman "L", Q', "C1", " AZE ", "", "2024-01-01", "2026-01-01T00:00:00Z", "x"])
        out.writerow(["two\nlines", "", "N/A", "SME", "2024-01-01", "2026-01-01T00:00:00Z", "x"])
    rows = landed.customers_csv(spark, str(tmp_path), multi_line=True).orderBy("customer_id").collect()
    assert [tuple(r) for r in rows] == [
        ("", "two\nlines", "N/A", "SME", "2024-01-01", "2026-01-01T00:00:00Z", "2026-08-24"),
        ("C1", 'Ləman "L", Q', " AZE ", "", "2024-01-01", "2026-01-01T00:00:00Z", "2026-08-24"),
    ]


def test_order_pages_keep_records_raw(spark, tmp_path):
    record = {"order_id": "o1", "updated_at": "2026-06-01T09:00:00Z", "new_field": {"a": [1]}}
    later = {"order_id": "o2", "updated_at": "2026-06-02T00:00:00Z"}
    (tmp_path / "p1.json").write_text(json.dumps({"data": [record, later], "next_cursor": "x", "page_size": 200}, indent=1))
    (tmp_path / "p2.json").write_text(json.dumps({"data": [], "next_cursor": None, "page_size": 200}, indent=1))
    records = landed.promoted(landed.order_pages(spark, str(tmp_path), one_page_per_file=True))
    assert sorted(json.loads(r.payload)["order_id"] for r in records.collect()) == ["o1", "o2"]
    (one,) = landed.order_slice(records, "2026-06-01", "2026-06-02").collect()
    assert (json.loads(one.payload), one._order_id) == (record, "o1")


def test_optional_source(spark, tmp_path):
    (tmp_path / "a_2026-01-01.txt").write_text("x\n")
    schema = spark.range(1).select(F.lit("").alias("value")).schema
    for pattern, rows in (("a_*.txt", 1), ("b_*.txt", 0)):
        path = f"{tmp_path}/{pattern}"
        df, found = landed.optional(spark, path, schema, lambda path=path: spark.read.text(path))
        assert (df.count(), found) == (rows, rows == 1)


def test_replacing_one_load_keeps_the_others(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "n int, _load_id string")
    path = str(tmp_path / "t")
    sinks.replace_loads(rows, path, ["a", "b"])
    sinks.replace_loads(rows.filter("n = 2").withColumn("n", F.lit(9)), path, ["b"])
    assert sorted((r.n, r._load_id) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]
    sinks.replace_loads(rows.limit(0), path, ["a"])
    assert [(r.n, r._load_id) for r in spark.read.parquet(path).collect()] == [(9, "b")]


def test_csv_files_with_other_column_orders(spark, tmp_path):
    names = ["customer_id", "full_name", "country", "segment", "signup_date", "updated_at"]
    for day, order in (("2026-08-24", names), ("2026-08-25", names[1::-1] + names[2:] + ["extra"])):
        row = {n: f"{n}-{day}" for n in names} | {"extra": "x"}
        (tmp_path / f"customers_snapshot_{day}.csv").write_text(",".join(order) + "\n" + ",".join(row[n] for n in order) + "\n")
    rows = landed.customers_csv(spark, str(tmp_path)).collect()
    assert len(rows) == 2 and all(r[n] == f"{n}-{r.snapshot_date}" for r in rows for n in names)


def test_unreadable_pages_are_never_lost(spark, tmp_path):
    (tmp_path / "p1.json").write_text(json.dumps({"data": [{"order_id": "o1"}], "next_cursor": None, "page_size": 1}))
    (tmp_path / "p2.json").write_text('{"data": [{"order_id": "o2"}, {"order')
    assert landed.order_pages(spark, str(tmp_path), strict=False).count() == 1
    (bad,) = landed.unreadable_pages(spark, str(tmp_path), "b", "orders_x").collect()
    assert bad.reason_code == "unreadable_page" and json.loads(bad.payload)["raw"].startswith('{"data": [{"order_id": "o2"}')
    with pytest.raises(Exception, match="unreadable page"):
        landed.order_pages(spark, str(tmp_path)).collect()


def test_rate_documents_by_line_and_file(spark, tmp_path):
    (tmp_path / "d.ndjson").write_text('{"date": "2026-08-24", "rates": []}\n\n{"date": "2026-08-26", "rates": []}\n')
    rows = landed.fx_documents(spark, str(tmp_path))
    assert sorted(r.rate_date for r in rows.collect()) == ["2026-08-24", "2026-08-26"]
    span = spark.sql("select date'2026-08-24' since, date'2026-08-27' until")
    assert [str(r.day) for r in landed.days_without_rates(rows, span).collect()] == ["2026-08-25"]


def test_compaction_writes_fewer_files(spark, tmp_path):
    path, out = str(tmp_path / "many"), str(tmp_path / "few")
    spark.range(1000).withColumn("day", F.col("id") % 2).repartition(20).write.partitionBy("day").parquet(path)
    assert sinks.compact(spark, path, out, ["day"]).agg(F.sum("id")).first()[0] == 499500
    assert len(list((tmp_path / "few").rglob("*.parquet"))) < len(list((tmp_path / "many").rglob("*.parquet")))
