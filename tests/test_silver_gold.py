"""Staging, merge, Gold and change classes on FIXTURES B."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import B1, B2, bronze_batch
from orderlake.operators import gold as G
from orderlake.operators.classify import classify_changes
from orderlake.operators.merge import changed_values, merge_latest
from orderlake.operators.staging import stage_latest
from orderlake.plans import reports


@pytest.fixture()
def batches(spark):
    b1 = bronze_batch(spark, B1, "b1", "2010-12-01 13:00:00")
    b2 = bronze_batch(spark, B2, "b2", "2010-12-02 13:00:00")
    return b1, b2


def qty(df):
    return {r.order_id: r.quantity for r in df.select("order_id", "quantity").collect()}


def test_stage_keeps_latest_and_drops_bad_rows(spark, batches):
    b1, b2 = batches
    s1 = stage_latest(b1)
    assert qty(s1) == {"A": 6, "B": 7, "C": 6}
    c = s1.filter("order_id = 'C'").collect()[0]
    assert c.updated_at == dt.datetime(2010, 12, 2, 23, 30)
    s2 = stage_latest(b2)
    assert qty(s2) == {"A": 99, "B": 70, "D": -2}  # NULL key and 'bad' timestamp dropped


def test_merge_separately_is_idempotent_and_strict(spark, batches):
    b1, b2 = batches
    silver = stage_latest(b1)
    cols = silver.columns
    after = merge_latest(silver, stage_latest(b2).select(*cols))
    assert qty(after) == {"A": 6, "B": 7, "C": 6, "D": -2}
    again = merge_latest(after, stage_latest(b2).select(*cols))
    assert sorted(map(tuple, again.drop("silver_updated_at").collect())) == sorted(map(tuple, after.drop("silver_updated_at").collect()))


def test_staging_together_prefers_newest_ingest(spark, batches):
    b1, b2 = batches
    assert qty(stage_latest(b1.unionByName(b2))) == {"A": 6, "B": 70, "C": 6, "D": -2}


def test_merge_keeps_null_seq_target_and_tracks_actions(spark):
    t = spark.createDataFrame([("k", None, 1), ("n", dt.datetime(2010, 1, 1), 2)], "order_id string, updated_at timestamp, quantity int")
    s = spark.createDataFrame([("k", dt.datetime(2011, 1, 1), 9), ("m", dt.datetime(2011, 1, 1), 3)], "order_id string, updated_at timestamp, quantity int")
    out = {r.order_id: (r.quantity, r._merge_action) for r in merge_latest(t, s, track=["quantity"]).collect()}
    assert out == {"k": (1, "keep"), "n": (2, "target_only"), "m": (3, "insert")}


def test_gold_tables_and_reports(spark, batches):
    b1, b2 = batches
    s1 = stage_latest(b1)
    silver = merge_latest(s1, stage_latest(b2).select(*s1.columns))
    daily = {r.event_date: r for r in G.daily_sales(silver, with_clock=False).collect()}
    d1, d2 = daily[dt.date(2010, 12, 1)], daily[dt.date(2010, 12, 2)]
    assert (d1.invoice_count, d1.customer_count, d1.line_count, d1.net_units, d1.net_revenue, d1.cancellation_lines) == (1, 1, 3, 19, Decimal("48.45"), 0)
    assert (d2.invoice_count, d2.customer_count, d2.line_count, d2.net_units, d2.net_revenue, d2.cancellation_lines) == (1, 1, 1, -2, Decimal("-2.00"), 1)
    prod = {r.product_id: (r.line_count, r.net_units, r.net_revenue, r.invoice_count) for r in G.product_performance(silver, with_clock=False).collect()}
    assert prod["85123A"] == (1, 6, Decimal("15.30"), 1) and prod["22139"] == (1, -2, Decimal("-2.00"), 1)
    country = G.country_revenue(silver, with_clock=False).collect()[0]
    assert (country.line_count, country.invoice_count, country.customer_count, country.net_revenue) == (4, 2, 2, Decimal("46.45"))
    status = {(r.order_status, r.is_cancellation): (r.line_count, r.invoice_count, r.net_units, r.net_revenue) for r in G.order_status_summary(silver, with_clock=False).collect()}
    assert status == {("completed", False): (3, 1, 19, Decimal("48.45")), ("cancelled", True): (1, 1, -2, Decimal("-2.00"))}
    k = reports.kpis(G.daily_sales(silver, with_clock=False)).collect()[0]
    assert (k.net_revenue, k.net_units, k.invoice_count, k.customer_count, k.line_count) == (46.45, 17, 2, 1, 4)
    rate = G.cancellation_rate(G.order_status_summary(silver, with_clock=False)).collect()[0]
    assert rate.cancellation_rate == 0.25
    top = reports.top_products(G.product_performance(silver, with_clock=False), n=2).collect()
    assert [r.product_id for r in top] == ["71053", "84406B"]  # tie at 15.30 broken by product_id and [r.row_num for r in top] == [1, 2]


def test_affected_dates_cover_old_and_new_partition(spark):
    cols = "order_id string, updated_at timestamp, event_date date, quantity int"
    t = spark.createDataFrame([("k", dt.datetime(2010, 1, 1), dt.date(2010, 1, 1), 1), ("z", dt.datetime(2010, 1, 1), dt.date(2010, 1, 5), 1)], cols)
    s = spark.createDataFrame([("k", dt.datetime(2010, 1, 2), dt.date(2010, 1, 3), 2)], cols)
    m = merge_latest(t, s, track=["event_date"])
    assert sorted(r.event_date for r in changed_values(m).collect()) == [dt.date(2010, 1, 1), dt.date(2010, 1, 3)]


def test_change_classes_fixture_b(spark, batches):
    b1, b2 = batches
    out = classify_changes(b1.unionByName(b2), keys=["order_id"], batch_col="batch_id")
    got = sorted((r.order_id, r.batch_id, r.quantity, r.change_class, r.is_late, r.row_count) for r in out.collect())
    assert got == sorted(
        [
            ("A", "b1", 6, "new", False, 1),
            ("A", "b1", 6, "replay", False, 1),
            ("B", "b1", 6, "new", False, 1),
            ("B", "b1", 7, "correction", False, 1),
            ("C", "b1", 6, "new", False, 1),
            ("C", "b1", 6, "correction", True, 1),
            ("A", "b2", 99, "replay", False, 1),
            ("B", "b2", 70, "replay", False, 1),
            ("D", "b2", -2, "new", False, 1),
        ]
    )


def test_change_order_follows_the_ingest_clock(spark):
    """Batch names do not sort like their numbers; the ingest clock decides."""
    cols = "order_id string, batch_id string, updated_at string, event_date string, ingested_at string, quantity int"
    rows = [("A", f"stream-bronze-{n}", f"2024-01-0{d}T00:00:00Z", "2024-01-01", f"2024-02-{d:02d} 00:00:00", q) for n, d, q in ((2, 2, 1), (10, 3, 2))]
    df = spark.createDataFrame(rows, cols).withColumn("ingested_at", F.to_timestamp("ingested_at")).withColumn("event_date", F.to_date("event_date"))
    got = {r.batch_id: r.change_class for r in classify_changes(df).collect()}
    assert got == {"stream-bronze-2": "new", "stream-bronze-10": "correction"}
