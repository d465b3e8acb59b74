"""Q1-Q6: the six report queries over Gold, as DataFrames.

Sorted reports also return ``row_num`` (the position in the report), so an
order-insensitive comparison still checks the order. Ties get explicit
tie-breaks; Top-N becomes a TakeOrderedAndProject (no global sort).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP_PRODUCTS = 15


def _numbered(df: DataFrame, *order) -> DataFrame:
    # A window without partitioning runs in one task; reports hold one row per
    # date / country / status / step, a size fixed by the calendar and the domain.
    return df.withColumn("row_num", F.row_number().over(Window.orderBy(*order)))


def kpis(daily_sales: DataFrame) -> DataFrame:
    """Q1: best-day customers (max), not distinct customers overall; sums of daily distincts."""
    return daily_sales.agg(
        F.sum("net_revenue").cast("double").alias("net_revenue"),
        F.sum("net_units").alias("net_units"),
        F.sum("invoice_count").alias("invoice_count"),
        F.max("customer_count").alias("customer_count"),
        F.sum("line_count").alias("line_count"),
    )


def daily_trend(daily_sales: DataFrame) -> DataFrame:
    """Q2: by date ascending."""
    out = daily_sales.select(
        "event_date",
        F.col("net_revenue").cast("double").alias("net_revenue"),
        "net_units",
        "invoice_count",
        "customer_count",
        "cancellation_lines",
    )
    return _numbered(out, F.col("event_date").asc())


def country(country_revenue: DataFrame) -> DataFrame:
    """Q3: revenue by country, descending."""
    out = country_revenue.select(
        "country",
        F.col("net_revenue").cast("double").alias("net_revenue"),
        "line_count",
        "invoice_count",
        "customer_count",
    )
    return _numbered(out, F.col("net_revenue").desc_nulls_last(), F.col("country").asc())


def top_products(product_performance: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    """Q4: top ``n`` products by revenue (the limit is the feature)."""
    top = product_performance.orderBy(
        F.col("net_revenue").desc_nulls_last(), F.col("product_id").asc(), F.col("product_name").asc()
    ).limit(n)
    out = top.select(
        "product_name",
        "product_id",
        F.col("net_revenue").cast("double").alias("net_revenue"),
        "net_units",
        "invoice_count",
        "line_count",
        F.col("net_revenue").alias("__rev"),
    )
    return _numbered(out, F.col("__rev").desc_nulls_last(), F.col("product_id").asc(), F.col("product_name").asc()).drop("__rev")


def order_status(order_status_summary: DataFrame) -> DataFrame:
    """Q5: one row per (status, flag); the flag is not shown."""
    out = order_status_summary.select(
        "order_status",
        F.col("net_revenue").cast("double").alias("net_revenue"),
        "net_units",
        "invoice_count",
        "line_count",
        "is_cancellation",
    )
    return _numbered(out, F.col("net_revenue").desc_nulls_last(), F.col("order_status").asc(), F.col("is_cancellation").asc()).drop(
        "is_cancellation"
    )


def health(pipeline_health: DataFrame) -> DataFrame:
    """Q6: health rows with ``success_flag`` 1/0, by step."""
    out = pipeline_health.select(
        "pipeline_step",
        "last_status",
        "last_run_at",
        F.when(F.col("last_status") == "success", 1).otherwise(0).alias("success_flag"),
    )
    return _numbered(out, F.col("pipeline_step").asc(), F.col("last_run_at").asc())
