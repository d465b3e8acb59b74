"""A merge writes new rows and the dates that lose one; other files of Silver stay as they are."""

from __future__ import annotations

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from orderlake.plans import silver_merge as sm
from orderlake.sources import tables as T
from orderlake.sources.schemas import SILVER_SCHEMA


def rows(spark, *some):
    """(key, day of January 2011 or None, hour of updated_at, invoice) as Silver rows."""
    out = []
    for key, day, hour, invoice in some:
        own = {"order_id": key, "event_date": day and dt.date(2011, 1, day), "updated_at": hour and dt.datetime(2011, 2, 1, hour), "invoice_no": invoice, "is_cancellation": False}
        out.append(tuple(own.get(f.name) for f in SILVER_SCHEMA.fields))
    return spark.createDataFrame(out, SILVER_SCHEMA)


def shown(df):
    return sorted(((r.order_id, r.event_date and r.event_date.day, r.updated_at and r.updated_at.hour, r.invoice_no) for r in df.collect()), key=str)


def files(lake, day):
    return {os.path.basename(p) for p in glob.glob(f"{lake.silver_orders}/event_date={day}/*.parquet")}


def test_dates_that_lose_no_row_keep_their_files(spark, lake_root):
    lake = T.Lake(lake_root, "parquet")
    T.overwrite(rows(spark, ("a", 1, 1, "i1"), ("b", 1, 1, "i1"), ("c", 2, 1, "i2"), ("d", 3, 5, "i3"), ("e", None, 1, "i4"), ("f", 4, 1, "i5")), lake.silver_orders, partition_by="event_date")
    before = {d: files(lake, d) for d in ("2011-01-01", "2011-01-02", "2011-01-03", "2011-01-04", sm.NULL_PARTITION)}
    # c moves to the 1st, d is older than what is there, f moves away from a date of its own, g and h are new
    staged = rows(spark, ("c", 1, 2, "i6"), ("d", 3, 4, "i7"), ("f", None, 2, "i8"), ("g", 1, 1, "i9"), ("h", 9, 1, "i1"))
    assert sm.merge(spark, lake, [staged], ["order_id"], f"{lake_root}/staging") == 1
    want = [("a", 1, 1, "i1"), ("b", 1, 1, "i1"), ("c", 1, 2, "i6"), ("d", 3, 5, "i3"), ("e", None, 1, "i4"), ("f", None, 2, "i8"), ("g", 1, 1, "i9"), ("h", 9, 1, "i1")]
    assert shown(spark.read.parquet(lake.silver_orders)) == sorted(want, key=str)
    for day in ("2011-01-01", "2011-01-03", sm.NULL_PARTITION):
        assert before[day] <= files(lake, day), day  # nothing there is written again
    assert files(lake, "2011-01-03") == before["2011-01-03"]
    assert not T.path_exists(spark, sm.partition_folder(lake, "2011-01-04")) and not files(lake, "2011-01-02")
    images = sorted((r.sign, r.invoice_no, r.event_date and r.event_date.day) for r in spark.read.parquet(f"{lake.changes}/load=1").collect() if r.event_date)
    assert images == [(-1, "i2", 2), (-1, "i5", 4), (1, "i1", 9), (1, "i6", 1), (1, "i9", 1)]


def test_rows_of_one_key_are_replaced_one_by_one(spark, lake_root):
    lake = T.Lake(lake_root, "parquet")
    T.overwrite(rows(spark, ("a", 1, 1, "i1"), ("a", 1, 2, "i2"), ("a", 2, 9, "i3"), ("a", 2, None, "i4"), (None, 1, 1, "i5")), lake.silver_orders, partition_by="event_date")
    sm.merge(spark, lake, [rows(spark, ("a", 3, 5, "new"))], ["order_id"], f"{lake_root}/staging")
    want = [("a", 3, 5, "new"), ("a", 3, 5, "new"), ("a", 2, 9, "i3"), ("a", 2, None, "i4"), (None, 1, 1, "i5")]
    assert shown(spark.read.parquet(lake.silver_orders)) == sorted(want, key=str)


def test_many_replaced_keys_are_not_sent_to_every_task(spark, lake_root, monkeypatch):
    monkeypatch.setattr(sm, "SENT_KEYS", 0)
    lake = T.Lake(lake_root, "parquet")
    T.overwrite(rows(spark, *[(f"k{i}", 1 + i % 3, 1, "old") for i in range(30)]), lake.silver_orders, partition_by="event_date")
    sm.merge(spark, lake, [rows(spark, *[(f"k{i}", 1 + i % 5, 2, "new") for i in range(20)])], ["order_id"], f"{lake_root}/staging")
    want = [(f"k{i}", 1 + i % (5 if i < 20 else 3), 2 if i < 20 else 1, "new" if i < 20 else "old") for i in range(30)]
    assert shown(spark.read.parquet(lake.silver_orders)) == sorted(want, key=str)


def test_a_table_is_there_once_it_has_a_file(spark, lake_root):
    path = f"{lake_root}/t"
    assert not T.table_exists(spark, path)
    T.overwrite(rows(spark).limit(0), path, partition_by="event_date")
    assert not T.table_exists(spark, path)
    T.append(rows(spark, ("a", None, 1, "i")).withColumn("a", F.lit(1)), path, partition_by="event_date")
    assert T.table_exists(spark, path)
