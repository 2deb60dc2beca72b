import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bazaar import functions as fn


def values(spark, texts, build):
    rows = [(k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "k int, t string").select("k", build(F.col("t")).alias("v"))
    return [r.v for r in df.orderBy("k").collect()]


def test_every_time_format_gives_the_same_instant(spark):
    texts = ["2026-06-01T08:30:00Z", "2026-06-01T12:30:00+04:00", "01.06.2026 12:30:00", "1780302600000", None]
    found = values(spark, texts, lambda t: F.unix_seconds(fn.mixed_timestamp(t)))
    assert found == [1780302600] * 4 + [None]
    formats = values(spark, texts, fn.timestamp_format)
    assert formats == ["iso_utc", "iso_offset", "dotted_local", "epoch_ms", None]


def test_local_time_follows_summer_time_of_the_past(spark):
    found = values(spark, ["01.07.1997 12:00:00", "01.07.2026 12:00:00"], lambda t: F.hour(fn.mixed_timestamp(t)))
    assert found == [7, 8]


def test_unreadable_time_is_an_error(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, ["yesterday"], fn.mixed_timestamp)


def test_price_takes_commas_and_blank(spark):
    found = values(spark, ["2,238.04", "129.9", "", None, "-5", "1e2"], fn.price)
    assert found == [Decimal("2238.04"), Decimal("129.9"), None, None, Decimal(-5), Decimal(100)]


def test_unreadable_price_is_an_error(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, ["cheap"], fn.price)


def test_country_mapping_is_case_sensitive(spark):
    found = values(spark, [" AZE ", "azerbaijan", "AZERBAIJAN", "TURKEY", "Türkiye", "N/A", "", None], fn.country)
    assert found == ["Azerbaijan", "Azerbaijan", "AZERBAIJAN", "Turkiye", "Turkiye", None, "", None]


def test_currency(spark):
    assert values(spark, ["azn", " USD ", "AZM", None], fn.currency) == ["AZN", "USD", "AZM", None]


def test_key_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("a", 1, "x"), (None, 1, "x")], "a string, b int, c string")
    keys = [r[0] for r in df.select(fn.joined_key("a", "b", "c")).collect()]
    assert keys == [hashlib.md5(b"a:1:x").hexdigest(), None]


def test_row_document_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None)], "a string, b int")
    assert df.select(fn.json_row(["a", "b"])).first()[0] == '{"a":"a","b":null}'


def test_local_date_crosses_midnight(spark):
    found = values(spark, ["2026-06-01T19:59:59Z", "2026-06-01T20:00:00Z"], lambda t: fn.local_date(t.cast("timestamp")))
    assert found == [dt.date(2026, 6, 1), dt.date(2026, 6, 2)]
