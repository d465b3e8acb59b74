"""Incremental Bronze ingest: each landing file enters Bronze once, Silver is merged per batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL
from orderlake.operators.events import to_order_events
from orderlake.plans import registry as R
from orderlake.sources import tables as T
from orderlake.streaming.bronze_stream import start_bronze_stream


def test_available_now_stream_ingests_each_file_once(spark, lake_root):
    lake = T.Lake(lake_root)
    lines = R.lines(spark, SF_SMALL)
    events = to_order_events(lines)
    day = F.to_date(F.col("event_time"))
    T.write_landing(events.withColumn("d", day), lake, F.col("d"), F.lit("s1"))
    total = events.count()
    keys = events.select("order_id").distinct().count()

    q = start_bronze_stream(spark, lake, checkpoint=lake.path("_checkpoints/test"))
    q.awaitTermination(300)
    assert T.read_table(spark, lake.bronze_orders).count() == total
    assert T.read_table(spark, lake.silver_orders).count() == keys

    q = start_bronze_stream(spark, lake, checkpoint=lake.path("_checkpoints/test"))  # nothing new
    q.awaitTermination(300)
    assert T.read_table(spark, lake.bronze_orders).count() == total
