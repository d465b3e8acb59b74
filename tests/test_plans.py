"""Physical-plan assertions: the shapes that make the operators scale."""

from __future__ import annotations

import datetime as dt
import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from conftest import SF_SMALL
from orderlake.operators import quality as Q
from orderlake.plans import registry as R
from orderlake.plans.all_queries import QUERIES
from orderlake.sources import tables as T


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_staging_uses_partial_window_group_limit(spark):
    p = plan(R.q_silver_stage_latest(spark, SF_SMALL), "simple")
    assert "WindowGroupLimit" in p
    # partial limit sits below the shuffle on the key: a hot key shrinks map-side
    below = p.split("Exchange hashpartitioning(order_id")[1]
    assert "WindowGroupLimit" in below


def test_top_products_is_take_ordered(spark):
    p = plan(R.q_report_top_products(spark, SF_SMALL), "simple")
    assert "TakeOrderedAndProject" in p


def test_duplicate_flag_is_aggregate_plus_join_not_window(spark):
    p = plan(R.q_dq_duplicate_flag(spark, SF_SMALL), "simple")
    assert "partial_count(1)" in p  # counted map-side before the shuffle
    assert "Window [" not in p.split("partial_count(1)")[0] or "count(1) windowspec" not in p


def test_quality_results_single_pass(spark):
    df = Q.quality_results(Q.add_duplicate_flag(R.silver_by_line(spark, SF_SMALL)))
    p = plan(df, "simple")
    # count_if is planned as count(if ...): all seven checks in ONE global aggregate
    assert p.count("partial_count(if") == len(Q.SILVER_ORDER_CHECKS)
    assert p.count("Exchange SinglePartition") == 1


def test_no_cartesian_product_anywhere(spark):
    for name, fn in QUERIES.items():
        p = plan(fn(spark, SF_SMALL), "simple")
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_scans_prune_columns_and_partitions(spark, lake_root):
    p = plan(R.q_gold_country_revenue(spark, SF_SMALL), "simple")
    lineitem_scan = [line for line in p.splitlines() if "lineitem.parquet" in line][0]
    assert "l_extendedprice" not in lineitem_scan and "l_suppkey" not in lineitem_scan
    lake = T.Lake(lake_root)
    rows = spark.createDataFrame([("k", dt.date(2010, 1, 1)), ("j", dt.date(2010, 1, 2))], "order_id string, event_date date")
    T.overwrite(rows, lake.silver_orders, partition_by="event_date")
    pruned = T.read_table(spark, lake.silver_orders).filter(F.col("event_date").isin([dt.date(2010, 1, 1)]))
    assert "PartitionFilters: [isnotnull(event_date" in plan(pruned, "simple")
