"""Row mapping (FIXTURES A) and the cleaning column functions."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from orderlake.functions import cleaning as C
from orderlake.operators.events import to_order_events

SAMPLE = ("536365", "85123A", "WHITE HANGING HEART T-LIGHT HOLDER", 6, dt.datetime(2010, 12, 1, 8, 26), 2.55, "17850", "United Kingdom")
SCHEMA = "InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate timestamp, UnitPrice double, CustomerID string, Country string"


def test_row_maps_to_order_event(spark):
    lines = spark.createDataFrame([SAMPLE], SCHEMA)
    ev = to_order_events(lines, arrival_date=F.lit("2010-12-01").cast("date")).collect()[0]
    assert ev.order_id == "536365|85123A|20101201082600"
    assert ev.invoice_no == "536365"
    assert ev.stock_code == ev.product_id == "85123A"
    assert ev.product_name == "WHITE HANGING HEART T-LIGHT HOLDER"
    assert ev.customer_id == "17850"
    assert ev.country == "United Kingdom"
    assert ev.currency == "GBP" and ev.channel == "online_retail"
    assert ev.source_system == "uci_online_retail"
    assert ev.order_status == "completed" and ev.is_cancellation is False
    assert ev.updated_at == "2010-12-01T12:00:00Z"
    assert ev.event_time == "2010-12-01T08:26:00Z"
    assert ev.unit_price == "2.55"
    assert ev.quantity == 6


def test_invoice_starting_with_c_is_cancelled_any_case(spark):
    rows = [("C536365",) + SAMPLE[1:], ("c536365",) + SAMPLE[1:]]
    out = to_order_events(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r.is_cancellation and r.order_status == "cancelled" for r in out)
    # without an arrival date the invoice date is used
    assert out[0].updated_at == "2010-12-01T12:00:00Z"


def test_clean_string_nulls_nan_and_unicode_edges(spark):
    df = spark.createDataFrame([(None, None), ("\t abc ", float("nan")), ("x y", 1.5)], "s string, d double")
    out = df.select(C.clean_string("s", df.schema["s"].dataType).alias("s"), C.clean_string("d", df.schema["d"].dataType).alias("d")).collect()
    assert [r.s for r in out] == ["", "abc", "x y"]
    assert [r.d for r in out] == ["", "", "1.5"]


def test_parse_int_and_decimal(spark):
    df = spark.createDataFrame([(None, 0.125), (float("nan"), 0.135), (6.7, float("nan")), (-6.7, 2.675)], "q double, p double")
    out = df.select(
        C.parse_int("q", df.schema["q"].dataType).alias("q"), C.parse_decimal("p", df.schema["p"].dataType).alias("p")
    ).collect()
    assert [r.q for r in out] == [0, 0, 6, -6]
    assert [r.p for r in out] == [Decimal("0.12"), Decimal("0.14"), Decimal("0.00"), Decimal("2.68")]
    bad = spark.createDataFrame([("abc",), ("1.005",)], "p string")
    got = [r[0] for r in bad.select(C.parse_decimal("p", bad.schema["p"].dataType)).collect()]
    assert got == [Decimal("0.00"), Decimal("1.00")]


def test_line_key_and_iso_formats(spark):
    df = spark.createDataFrame([(dt.datetime(2010, 12, 1, 8, 26), dt.datetime(2010, 12, 1, 8, 26, 0, 500))], "a timestamp, b timestamp")
    r = df.select(
        C.line_key(F.lit("536365"), F.lit("85123A"), F.col("a")).alias("k"), C.iso_utc("a").alias("x"), C.iso_utc("b").alias("y")
    ).collect()[0]
    assert r.k == "536365|85123A|20101201082600"
    assert r.x == "2010-12-01T08:26:00Z"
    assert r.y == "2010-12-01T08:26:00.000500Z"
