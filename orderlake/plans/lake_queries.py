"""Queries on tables that the jobs wrote from the given tables, read back by path or through the catalog.

All faulty lines land as JSON in two batches, before and from the cutover; each is ingested, merged into
Silver and taken into Gold (the second by the change feed), the quality checks run once, and everything is
published. There are two such lakes: the daily tables are read from one whose lines keep their own dates, the
others from one whose lines are billed on the first day of their month (some eighty date partitions). A lake is
written to the shared folder at the first of its queries in a session, once for a set of tables; the queries only
read. Clock columns and paths are left out.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.plans import catalog_reports as cr
from orderlake.plans import jobs
from orderlake.plans import registry as R
from orderlake.plans import silver_merge as sm
from orderlake.session import SHORT_SHUFFLES, ensure_checkpoint_dir, settings
from orderlake.sources import tables as T
from orderlake.sources.schemas import LANDING_COLUMNS

BATCHES = ("lake-1", "lake-2")
#: Gold tables and reports whose rows are days.
DAILY = ("daily_sales", "daily_trend")
_LAKES: dict[tuple[str, str, bool], tuple[T.Lake, str]] = {}


def written_lake(spark: SparkSession, sf: str, daily: bool = False) -> tuple[T.Lake, str]:
    """The lake of the given tables and the prefix of its catalog; ``daily``: the one whose lines keep their own dates."""
    key = (spark.sparkContext.applicationId, sf, daily)
    if key not in _LAKES:
        # only a local session (tests) may go without a shared folder and then gets one of its own
        own = tempfile.mkdtemp(prefix="orderlake-lake-") if spark.sparkContext.master.startswith("local") else None
        tag = uuid.uuid4().hex[:8]
        lake = T.Lake(f"{ensure_checkpoint_dir(spark, own).rstrip('/')}/lake-{tag}", "parquet")
        _LAKES[key] = (lake, f"lake_{tag}_")
        try:
            with settings(spark, SHORT_SHUFFLES):
                _write(spark, sf, *_LAKES[key], daily)
        except BaseException:
            del _LAKES[key]
            raise
    return _LAKES[key]


def _write(spark: SparkSession, sf: str, lake: T.Lake, prefix: str, daily: bool) -> None:
    billed = R.faulty_lines(spark, sf)
    if not daily:
        billed = billed.withColumn("InvoiceDate", F.date_trunc("month", "InvoiceDate").cast("timestamp_ntz"))
    ev = R.events(spark, sf, billed)
    cut = F.lit(R.MERGE_CUTOVER).cast("date")
    batch = F.when(F.substring("updated_at", 1, 10).cast("date") < cut, F.lit(BATCHES[0])).otherwise(F.lit(BATCHES[1]))
    T.write_landing(ev, lake, cut, batch, few=True)
    for name in BATCHES:
        jobs.ingest_bronze(spark, lake, name, source=f"{lake.landing}/event_date={R.MERGE_CUTOVER}/batch_id={name}")
        jobs.merge_silver(spark, lake, name, batch_ids=[name])
        if name == BATCHES[-1]:
            jobs.run_quality_checks(spark, lake, name, fail_on_critical=False)
        jobs.build_gold_tables(spark, lake, name)
    T.publish(spark, lake, prefix)


def lake_landing(spark: SparkSession, sf: str) -> DataFrame:
    """The landing files of both batches."""
    lake, _ = written_lake(spark, sf)
    return T.read_landing(spark, lake.landing).select(*LANDING_COLUMNS, "batch_id")


def lake_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze by path."""
    lake, _ = written_lake(spark, sf)
    return T.read_table(spark, lake.bronze_orders).select(*LANDING_COLUMNS, "batch_id", "event_date")


def lake_batch(spark: SparkSession, sf: str) -> DataFrame:
    """L2: the second batch's rows, from the partitions that the batch index names."""
    lake, _ = written_lake(spark, sf)
    return sm.bronze_of_batches(spark, lake, [BATCHES[1]]).select(*LANDING_COLUMNS, "event_date")


def lake_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Silver through the catalog, after a first load and a merge."""
    _, prefix = written_lake(spark, sf)
    return R._ntz(spark.table(f"{prefix}silver.orders").select(*[c for c in R.SILVER_OUT if c != "source_file"]))


def lake_dq_results(spark: SparkSession, sf: str) -> DataFrame:
    """The results of the quality job."""
    lake, _ = written_lake(spark, sf)
    return T.read_table(spark, lake.dq_results).drop("created_at")


def lake_rejected(spark: SparkSession, sf: str) -> DataFrame:
    """K7, L3: rejected rows."""
    lake, _ = written_lake(spark, sf)
    return T.read_table(spark, lake.rejected).select("order_id", "invoice_no", "stock_code", "quantity", "unit_price", "country", "run_id", "check_name", "severity")


def lake_run_log(spark: SparkSession, sf: str) -> DataFrame:
    """K5, L1-L4: what the jobs logged."""
    lake, _ = written_lake(spark, sf)
    return T.read_table(spark, lake.run_log).select("run_id", "pipeline_step", "status", "row_count")


def _gold(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        lake, _ = written_lake(spark, sf, name in DAILY)
        return T.read_table(spark, lake.gold(name)).drop("gold_updated_at")

    return query


def _report(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        _, prefix = written_lake(spark, sf, name in DAILY)
        rows = cr.run_report(spark, name, prefix)
        return rows.drop("last_run_at") if name == "health" else rows

    return query


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "lake_landing": lake_landing,
    "lake_bronze": lake_bronze,
    "lake_batch": lake_batch,
    "lake_silver": lake_silver,
    "lake_dq_results": lake_dq_results,
    "lake_rejected": lake_rejected,
    "lake_run_log": lake_run_log,
    **{f"lake_gold_{name}": _gold(name) for name in ("daily_sales", "product_performance", "country_revenue", "order_status_summary")},
    **{f"catalog_{name}": _report(name) for name in cr.REPORTS},
}
