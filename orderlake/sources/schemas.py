"""Column lists and explicit schemas for every layer (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Names, types and order of every layer's columns. Column lists follow from the schemas.

# Raw invoice lines (the 8 projected source columns).
SOURCE_LINE_COLUMNS = [
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
]

LANDING_SCHEMA = StructType(
    [
        StructField("order_id", StringType()),
        StructField("invoice_no", StringType()),
        StructField("stock_code", StringType()),
        StructField("customer_id", StringType()),
        StructField("product_id", StringType()),
        StructField("product_name", StringType()),
        StructField("order_status", StringType()),
        StructField("quantity", LongType()),
        StructField("unit_price", StringType()),
        StructField("currency", StringType()),
        StructField("channel", StringType()),
        StructField("country", StringType()),
        StructField("is_cancellation", BooleanType()),
        StructField("event_time", StringType()),
        StructField("updated_at", StringType()),
        StructField("source_system", StringType()),
    ]
)

LANDING_COLUMNS = LANDING_SCHEMA.names

BRONZE_EXTRA_COLUMNS = ["raw_payload", "source_file", "batch_id", "ingested_at", "event_date"]
BRONZE_COLUMNS = LANDING_COLUMNS + BRONZE_EXTRA_COLUMNS

SILVER_SCHEMA = StructType(
    [
        StructField("order_id", StringType()),
        StructField("invoice_no", StringType()),
        StructField("stock_code", StringType()),
        StructField("customer_id", StringType()),
        StructField("product_id", StringType()),
        StructField("product_name", StringType()),
        StructField("order_status", StringType()),
        StructField("quantity", IntegerType()),
        StructField("unit_price", DecimalType(12, 2)),
        StructField("currency", StringType()),
        StructField("channel", StringType()),
        StructField("country", StringType()),
        StructField("is_cancellation", BooleanType()),
        StructField("event_time", TimestampType()),
        StructField("updated_at", TimestampType()),
        StructField("source_system", StringType()),
        StructField("source_file", StringType()),
        StructField("bronze_batch_id", StringType()),
        StructField("bronze_ingested_at", TimestampType()),
        StructField("event_date", DateType()),
        StructField("order_amount", DecimalType(23, 2)),
        StructField("silver_updated_at", TimestampType()),
    ]
)

SILVER_COLUMNS = SILVER_SCHEMA.names

# Clock columns: differ on every run, left out of comparisons.
CLOCK_COLUMNS = {"ingested_at", "bronze_ingested_at", "silver_updated_at", "gold_updated_at", "rejected_at"}

RUN_LOG_SCHEMA = StructType(
    [
        StructField("run_id", StringType()),
        StructField("pipeline_step", StringType()),
        StructField("status", StringType()),
        StructField("row_count", LongType()),
        StructField("message", StringType()),
        StructField("created_at", TimestampType()),
    ]
)

DQ_RESULT_SCHEMA = StructType(
    [
        StructField("run_id", StringType()),
        StructField("check_name", StringType()),
        StructField("table_name", StringType()),
        StructField("severity", StringType()),
        StructField("status", StringType()),
        StructField("failed_count", LongType()),
        StructField("total_count", LongType()),
        StructField("failure_rate", DoubleType()),
        StructField("description", StringType()),
        StructField("failure_expression", StringType()),
        StructField("created_at", TimestampType()),
    ]
)

DQ_RESULT_COLUMNS = DQ_RESULT_SCHEMA.names

# Arrivals that did not become rows of Silver, with the reason and their text.
QUARANTINE_SCHEMA = StructType(
    [
        StructField("run_id", StringType()),
        StructField("reason", StringType()),
        StructField("batch_id", StringType()),
        StructField("source_file", StringType()),
        StructField("record", StringType()),
        StructField("quarantined_at", TimestampType()),
    ]
)

HEALTH_COLUMNS = ["pipeline_step", "last_run_at", "last_status", "last_message"]
