"""The shared work folder, where the session runs on a cluster."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from bazaar import session


@pytest.fixture
def cluster(spark, monkeypatch):
    """As on several machines, whose shared folder is one that all of them mount."""
    monkeypatch.setattr(session, "_SHARED", set(), raising=False)
    monkeypatch.setattr(spark.sparkContext, "master", "spark://elsewhere:7077")
    return spark


def test_mounted_folder_serves_a_cluster(cluster, tmp_path):
    people = [(1, "BUILDING"), (2, "BUILDING"), (3, "MACHINERY")]
    cluster.createDataFrame(people, "c_custkey long, c_mktsegment string").write.parquet(f"{tmp_path}/in/customer.parquet")
    rows = entry.queries()["export_csv"](cluster, f"{tmp_path}/in").collect()
    assert {(r["c_mktsegment"], r["customers"]) for r in rows} == {("BUILDING", 2), ("MACHINERY", 1)}


def test_rows_come_back_from_a_shared_folder(cluster, tmp_path):
    assert session._come_back(cluster, f"file://{tmp_path}")
    assert [p for p in tmp_path.rglob("*") if p.is_file()] == []


def test_folder_that_lacks_rows_is_refused(cluster, monkeypatch):
    monkeypatch.setattr(session, "_come_back", lambda spark, root: False)
    with pytest.raises(ValueError, match="shared by all executors"):
        session.workspace(cluster, "rows")


def test_shared_tables_are_written_again_after_cleaning(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_home", lambda spark: f"{tmp_path}/shared")
    orders = [(1, 1, "F", "1996-02-07"), (2, 1, "O", "1996-02-12")]  # a Wednesday and a Monday, as shifted too
    orders = spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate string")
    orders.withColumn("o_orderdate", F.to_timestamp_ntz("o_orderdate")).write.parquet(f"{tmp_path}/in/orders.parquet")
    found = [entry.queries()["asof_fx"](spark, f"{tmp_path}/in").collect()]
    session.clean(spark)
    found.append(entry.queries()["asof_fx"](spark, f"{tmp_path}/in").collect())
    for part in [p for p in tmp_path.glob("shared/bronze_fx-*/*") if p.name.startswith("part-")]:
        part.unlink()  # the folder stays, its rows are gone
    found.append(entry.queries()["asof_fx"](spark, f"{tmp_path}/in").collect())
    assert [sorted(r["rate_azn"] is not None for r in rows) for rows in found] == [[True, True]] * 3
