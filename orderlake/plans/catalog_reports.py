"""Q1-Q6 as SQL text over the published catalog, for dashboards and notebooks.

``report_sql`` gives the text of a report for a catalog prefix, ``run_report`` runs it. Each reads one
published Gold table; the order of a sorted report is also its last column, ``row_num``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: The Gold table, the columns shown and the order (none: one row) of each report.
_KPIS = "CAST(sum(net_revenue) AS DOUBLE) AS net_revenue, sum(net_units) AS net_units, sum(invoice_count) AS invoice_count, max(customer_count) AS customer_count, sum(line_count) AS line_count"
REPORTS: dict[str, tuple[str, str, str | None]] = {
    "kpis": ("daily_sales", _KPIS, None),
    "daily_trend": ("daily_sales", "event_date, CAST(net_revenue AS DOUBLE) AS net_revenue, net_units, invoice_count, customer_count, cancellation_lines", "event_date"),
    "country": ("country_revenue", "country, CAST(net_revenue AS DOUBLE) AS net_revenue, line_count, invoice_count, customer_count", "net_revenue DESC NULLS LAST, country"),
    "top_products": (
        "product_performance",
        "product_name, product_id, CAST(net_revenue AS DOUBLE) AS net_revenue, net_units, invoice_count, line_count",
        "net_revenue DESC NULLS LAST, product_id, product_name LIMIT 15",
    ),
    "order_status": (
        "order_status_summary",
        "order_status, CAST(net_revenue AS DOUBLE) AS net_revenue, net_units, invoice_count, line_count",
        "net_revenue DESC NULLS LAST, order_status, is_cancellation",
    ),
    "health": ("pipeline_health", "pipeline_step, last_status, last_run_at, CASE last_status WHEN 'success' THEN 1 ELSE 0 END AS success_flag", "pipeline_step, last_run_at"),
}


def report_sql(name: str, catalog_prefix: str = "") -> str:
    """The text of a report. The rank is worked out on the table's own columns, the cut on the rank."""
    table, columns, order = REPORTS[name]
    source = f"{catalog_prefix}gold.{table}"
    if order is None:
        return f"SELECT {columns} FROM {source}"
    order, _, limit = order.partition(" LIMIT ")
    top = f" WHERE row_num <= {limit}" if limit else ""
    return f"SELECT * FROM (SELECT {columns}, row_number() OVER (ORDER BY {order}) AS row_num FROM {source}){top}"


def run_report(spark: SparkSession, name: str, catalog_prefix: str = "") -> DataFrame:
    return spark.sql(report_sql(name, catalog_prefix))
