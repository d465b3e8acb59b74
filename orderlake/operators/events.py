"""Source lines -> landing order events (one ``select``; no per-row Python)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions import cleaning as C


def to_order_events(
    lines: DataFrame,
    arrival_date: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Map raw invoice lines to the 16 landing columns (plus ``keep`` pass-through columns).

    ``arrival_date`` is the day the line reached the lake; its noon (UTC) becomes
    ``updated_at``. Without it the invoice date is used, as for a same-day load.
    """
    types = {f.name: f.dataType for f in lines.schema.fields}
    cleaned = lines.select(
        C.clean_string("InvoiceNo", types["InvoiceNo"]).alias("__invoice"),
        C.clean_string("StockCode", types["StockCode"]).alias("__stock"),
        C.clean_string("Description", types["Description"]).alias("__description"),
        C.clean_string("CustomerID", types["CustomerID"]).alias("__customer"),
        C.clean_string("Country", types["Country"]).alias("__country"),
        C.parse_int("Quantity", types["Quantity"]).alias("__quantity"),
        C.parse_decimal("UnitPrice", types["UnitPrice"]).alias("__price"),
        C.parse_datetime("InvoiceDate", types["InvoiceDate"]).alias("__invoice_ts"),
        (arrival_date if arrival_date is not None else F.lit(None).cast("date")).alias("__arrival"),
        *[F.col(c) for c in keep],
    )
    cancelled = C.is_cancellation(F.col("__invoice"))
    arrival = F.coalesce(F.col("__arrival"), F.to_date(F.col("__invoice_ts")))
    return cleaned.select(
        C.line_key(F.col("__invoice"), F.col("__stock"), F.col("__invoice_ts")).alias("order_id"),
        F.col("__invoice").alias("invoice_no"),
        F.col("__stock").alias("stock_code"),
        F.col("__customer").alias("customer_id"),
        F.col("__stock").alias("product_id"),
        F.col("__description").alias("product_name"),
        C.order_status(cancelled).alias("order_status"),
        F.col("__quantity").alias("quantity"),
        F.col("__price").cast("string").alias("unit_price"),
        F.lit(C.CURRENCY).alias("currency"),
        F.lit(C.CHANNEL).alias("channel"),
        F.col("__country").alias("country"),
        cancelled.alias("is_cancellation"),
        C.iso_utc(F.col("__invoice_ts")).alias("event_time"),
        C.arrival_stamp(arrival).alias("updated_at"),
        F.lit(C.SOURCE_SYSTEM).alias("source_system"),
        *[F.col(c) for c in keep],
    )
