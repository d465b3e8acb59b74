"""Quality checks (FIXTURES C) and pipeline health (FIXTURES D)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fixtures import ops_rows, silver_rows
from orderlake.operators import health as H
from orderlake.operators import quality as Q
from orderlake.plans import reports

EXPECTED_FAILED = {
    "silver_order_id_not_null": 1,
    "silver_no_duplicate_order_ids": 2,
    "silver_updated_at_not_null": 1,
    "silver_quantity_not_zero": 2,
    "silver_unit_price_non_negative": 1,
    "silver_invoice_no_present": 1,
    "silver_country_present": 1,
}


def test_check_definitions():
    names = Q.check_names()
    assert len(names) == len(set(names)) == 7
    assert {c.name for c in Q.SILVER_ORDER_CHECKS if c.severity == "warning"} == {"silver_invoice_no_present", "silver_country_present"}


def test_results_rejects_and_gate(spark):
    flagged = Q.add_duplicate_flag(silver_rows(spark))
    results = {r.check_name: r for r in Q.quality_results(flagged, run_id="r1").collect()}
    assert {k: v.failed_count for k, v in results.items()} == EXPECTED_FAILED
    assert all(r.total_count == 7 for r in results.values())
    assert results["silver_quantity_not_zero"].failure_rate == 2 / 7
    assert results["silver_quantity_not_zero"].status == "fail"
    rejected = Q.rejected_records(flagged, run_id="r1")
    assert rejected.count() == 9
    assert set(rejected.columns) >= {"run_id", "check_name", "severity", "rejected_at", Q.DUPLICATE_FLAG}
    gate = Q.critical_failures(Q.quality_results(flagged, run_id="r1"))
    assert gate.count() == 5


def test_empty_table_passes(spark):
    empty = Q.add_duplicate_flag(silver_rows(spark).limit(0))
    rows = Q.quality_results(empty).collect()
    assert all(r.status == "pass" and r.failure_rate == 0.0 and r.total_count == 0 for r in rows)
    assert Q.rejected_records(empty).count() == 0


def test_duplicate_flag_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "order_id string")
    flags = sorted((r.order_id or "", r[Q.DUPLICATE_FLAG]) for r in Q.add_duplicate_flag(df).collect())
    assert flags == [("", True), ("", True), ("a", False)]


def test_freshness(spark):
    df = spark.createDataFrame([(dt.datetime(2010, 12, 1, 8, 0),)], "event_time timestamp")
    fresh = Q.freshness_check(df, F.lit("2010-12-01 20:00:00").cast("timestamp")).collect()[0]
    stale = Q.freshness_check(df, F.lit("2010-12-03 00:00:00").cast("timestamp")).collect()[0]
    assert (fresh.status, fresh.lag_hours) == ("pass", 12.0)
    assert stale.status == "fail"


def test_pipeline_health_and_report(spark):
    log, dq = ops_rows(spark)
    rows = {r.pipeline_step: r for r in H.pipeline_health(log, dq).collect()}
    assert (rows["bronze_orders"].last_run_at, rows["bronze_orders"].last_status, rows["bronze_orders"].last_message) == (
        dt.datetime(2010, 12, 1, 11, 0), "success", "m2")
    assert (rows["quality_checks"].last_status, rows["quality_checks"].last_message) == ("failed", "m3")
    s = rows["data_quality_summary"]
    assert (s.last_run_at, s.last_status, s.last_message) == (dt.datetime(2010, 12, 1, 11, 5), "failed", "DQ failures: 1")
    flags = [(r.pipeline_step, r.success_flag) for r in reports.health(H.pipeline_health(log, dq)).orderBy("row_num").collect()]
    assert flags == [("bronze_orders", 1), ("data_quality_summary", 0), ("quality_checks", 0)]


def test_duplicate_count_without_flag_matches_flagged(spark):
    rows = silver_rows(spark)
    flagged = {r.check_name: r.failed_count for r in Q.quality_results(Q.add_duplicate_flag(rows)).collect()}
    direct = {r.check_name: r.failed_count for r in Q.quality_results(rows, duplicate_keys=["order_id"]).collect()}
    assert flagged == direct == EXPECTED_FAILED
    empty = Q.quality_results(rows.limit(0), duplicate_keys=["order_id"]).collect()
    assert all(r.failed_count == 0 and r.status == "pass" for r in empty)


def test_latest_runs_cover_the_batches_of_all_lines(spark):
    from orderlake.plans import backfill as bf
    from orderlake.plans import registry as R
    from conftest import SF_SMALL

    rows = silver_rows(spark).withColumn("bronze_batch_id", F.when(F.col("order_id") == "k1", F.lit("b1")).otherwise(F.lit("b2")))
    runs = {(r.run_id, r.pipeline_step): (r.status, r.row_count) for r in bf.batch_runs(rows).collect()}
    assert runs == {
        ("b1", "bronze_orders"): ("success", 1), ("b1", "silver_orders"): ("success", 1), ("b1", "quality_checks"): ("success", 7),
        ("b2", "bronze_orders"): ("success", 6), ("b2", "silver_orders"): ("success", 5), ("b2", "quality_checks"): ("failed", 7),
    }
    twins = rows.filter("order_id = 'k5'").withColumn("bronze_batch_id", F.lit("b3"))
    assert {r.status for r in bf.batch_runs(twins).filter("pipeline_step = 'quality_checks'").collect()} == {"failed"}
    steps = {r.pipeline_step for r in R.q_run_log_latest(spark, SF_SMALL).collect()}
    assert steps > {"bronze_orders", "silver_orders", "quality_checks"}
