"""Hand-written rows of FIXTURES.md (B: Bronze events, C: Silver rows, D: ops rows)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.operators.bronze import prepare_bronze
from orderlake.sources.schemas import DQ_RESULT_SCHEMA, LANDING_SCHEMA, RUN_LOG_SCHEMA

KEYS = {"A": "85123A", "B": "71053", "C": "84406B", "D": "22139", "E": "85123A", None: "85123A"}


def event(key, stock, qty, updated, invoice="536365", customer="17850", price="2.55", event_time="2010-12-01T08:26:00Z", cancelled=False, source="uci_online_retail"):
    return (
        key, invoice, stock, customer, stock, f"product {stock}", "cancelled" if cancelled else "completed",
        qty, price, "GBP", "online_retail", "United Kingdom", cancelled, event_time, updated, source,
    )


B1 = [
    event("A", "85123A", 6, "2010-12-01T12:00:00Z"),
    event("A", "85123A", 6, "2010-12-01T12:00:00Z"),
    event("B", "71053", 6, "2010-12-01T12:00:00Z"),
    event("B", "71053", 7, "2010-12-01T16:00:00Z", source="uci_online_retail_correction"),
    event("C", "84406B", 6, "2010-12-01T12:00:00Z"),
    event("C", "84406B", 6, "2010-12-02T23:30:00Z", source="uci_online_retail_late_arrival"),
]
B2 = [
    event("A", "85123A", 99, "2010-12-01T11:00:00Z"),
    event("B", "71053", 70, "2010-12-01T16:00:00Z"),
    event("D", "22139", -2, "2010-12-02T12:00:00Z", invoice="C536379", customer="", price="1.00", event_time="2010-12-02T09:00:00Z", cancelled=True),
    event(None, "85123A", 1, "2010-12-02T12:00:00Z"),
    event("E", "85123A", 1, "bad"),
]


def bronze_batch(spark: SparkSession, rows, batch_id: str, ingested: str) -> DataFrame:
    events = spark.createDataFrame(rows, LANDING_SCHEMA)
    return prepare_bronze(events, batch_id=batch_id, source_file=f"landing/{batch_id}.jsonl", ingested_at=F.lit(ingested).cast("timestamp"))


def silver_rows(spark: SparkSession) -> DataFrame:
    """FIXTURES C: seven Silver-shaped rows."""
    t = dt.datetime(2010, 12, 1, 12, 0)
    rows = [
        ("k1", t, 6, Decimal("2.55"), "536365", "UK"),
        ("k2", t, 0, Decimal("2.55"), "536365", "UK"),
        ("k3", t, 1, Decimal("-1.00"), "536365", ""),
        ("  ", t, 1, Decimal("1.00"), None, "UK"),
        ("k5", t, 1, Decimal("1.00"), "536366", "UK"),
        ("k5", t, 1, Decimal("1.00"), "536366", "UK"),
        ("k7", None, None, Decimal("1.00"), "536366", "UK"),
    ]
    return spark.createDataFrame(
        rows, "order_id string, updated_at timestamp, quantity int, unit_price decimal(12,2), invoice_no string, country string"
    )


def ops_rows(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """FIXTURES D: run log and DQ results."""
    d = lambda h, m: dt.datetime(2010, 12, 1, h, m)
    log = spark.createDataFrame(
        [
            ("r1", "bronze_orders", "success", 10, "m1", d(10, 0)),
            ("r2", "bronze_orders", "success", 10, "m2", d(11, 0)),
            ("r3", "quality_checks", "failed", 7, "m3", d(11, 5)),
        ],
        RUN_LOG_SCHEMA,
    )
    dq = spark.createDataFrame(
        [
            ("q1", "c1", "silver.orders", "critical", "fail", 1, 10, 0.1, "", "", d(10, 5)),
            ("q1", "c2", "silver.orders", "warning", "pass", 0, 10, 0.0, "", "", d(10, 5)),
            ("q2", "c1", "silver.orders", "critical", "pass", 0, 10, 0.0, "", "", d(11, 5)),
            ("q2", "c2", "silver.orders", "warning", "pass", 0, 10, 0.0, "", "", d(11, 5)),
        ],
        DQ_RESULT_SCHEMA,
    )
    return log, dq
