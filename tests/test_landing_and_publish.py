"""Quarantine, unreadable numbers, replayed epochs and published versions."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from fixtures import event
from orderlake.functions import cleaning as C
from orderlake.plans import jobs
from orderlake.plans import silver_merge as sm
from orderlake.sources import tables as T
from orderlake.sources.schemas import LANDING_SCHEMA
from orderlake.streaming import bronze_stream as bs


def landed(lake_root, lines):
    path = f"{lake_root}/in"
    import os

    os.makedirs(path, exist_ok=True)
    with open(f"{path}/a.json", "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def as_json(row):
    return json.dumps(dict(zip(LANDING_SCHEMA.names, row, strict=True)))


def events(spark):
    return [
        event("A", "85123A", 1, "2010-12-01T12:00:00Z"),
        event("B", "85123A", 1, "not a time"),
        event("C", "85123A", 1, None),
        event(None, "85123A", 1, "2010-12-01T12:00:00Z"),
        event("D", "85123A", 1, "2010-12-01T12:00:00Z"),
    ]


def test_dropped_arrivals_are_counted_and_kept(spark, lake_root):
    lake = T.Lake(lake_root, "parquet")
    path = landed(lake_root, [*map(as_json, events(spark)), '{"order_id": "E", ', "[1, 2", '{"order_id": "F", "quantity": "many"}'])
    assert jobs.ingest_bronze(spark, lake, "b1", source=path) == 8
    assert jobs.merge_silver(spark, lake, "s1", batch_ids=["b1"]) == 2
    rows = T.read_table(spark, lake.quarantine).collect()
    reasons = sorted((r.run_id, r.reason) for r in rows)
    bronze_side = [r for r in reasons if r[0] == "b1"]
    assert bronze_side == [("b1", "malformed_json")] * 3
    assert {r.record for r in rows if r.run_id == "b1"} >= {'{"order_id": "E", ', "[1, 2"}
    staged = [r[1] for r in reasons if r[0] == "s1"]
    assert staged.count("unreadable_time") == 1 and staged.count("null_key") >= 3 and staged.count("no_time") >= 1
    log = {r.run_id: r.message for r in T.read_table(spark, lake.run_log).collect()}
    assert "3 lines are no JSON record" in log["b1"]
    assert "1 unreadable_time" in log["s1"] and f"{staged.count('null_key')} null_key" in log["s1"]


def test_nothing_dropped_leaves_no_quarantine(spark, lake_root):
    lake = T.Lake(lake_root, "parquet")
    jobs.ingest_bronze(spark, lake, "b1", source=landed(lake_root, [as_json(events(spark)[0])]))
    jobs.merge_silver(spark, lake, "s1", batch_ids=["b1"])
    assert not T.table_exists(spark, lake.quarantine)
    assert "dropped: none" in {r.run_id: r.message for r in T.read_table(spark, lake.run_log).collect()}["s1"]


def test_numbers_in_text_and_numbers_that_cannot_be_read(spark):
    df = spark.createDataFrame([("6.7",), ("-6.7",), ("12",), ("abc",), (None,), ("",), ("123456789012345678901.239",), ("0.125",)], "s string")
    t = df.schema["s"].dataType
    out = df.select(C.parse_int("s", t).alias("i"), C.parse_decimal("s", t).cast("string").alias("d"), C.unreadable("s", t).alias("zi"), C.unreadable("s", t, "decimal").alias("zd")).collect()
    assert [r.i for r in out] == [6, -6, 12, 0, 0, 0, 0, 0]
    assert [r.d for r in out] == ["6.70", "-6.70", "12.00", "0.00", "0.00", "0.00", "123456789012345678901.24", "0.12"]
    assert [r.zi for r in out] == [False, False, False, True, False, True, True, False]
    assert [r.zd for r in out] == [False, False, False, True, False, True, False, False]


def test_a_day_tells_its_zeroed_numbers(spark, lake_root):
    lake = T.Lake(lake_root, "parquet")
    rows = [("1", "S", "D", q, dt.datetime(2010, 12, 1, 9), p, "c", "UK") for q, p in [("1", "1.00"), ("many", "2.00"), ("3", "free"), (None, None)]]
    lines = spark.createDataFrame(rows, "InvoiceNo string, StockCode string, Description string, Quantity string, InvoiceDate timestamp, UnitPrice string, CustomerID string, Country string")
    out = jobs.run_day(spark, lake, lines, dt.date(2010, 12, 1), fail_on_critical=False)
    assert (out["quantities_zeroed"], out["prices_zeroed"], out["bronze_rows"]) == (1, 1, 4)


def bronze_rows(spark, lake):
    return sorted(map(str, T.read_table(spark, lake.bronze_orders).drop("ingested_at").collect()))


@pytest.mark.parametrize("step", [None, "move", "delete_path", "merge_silver"])
def test_a_replayed_epoch_enters_once(spark, lake_root, monkeypatch, step):
    lake = T.Lake(lake_root, "parquet")
    first = spark.createDataFrame(events(spark)[:2], LANDING_SCHEMA).withColumn("__file", F.lit("f1"))
    more = [event("G", "1", 1, "2010-12-03T12:00:00Z", event_time=t) for t in ("2010-12-01T08:00:00Z", "2010-12-02T08:00:00Z", "bad")]
    second = spark.createDataFrame(more, LANDING_SCHEMA).withColumn("__file", F.lit("f2"))
    bs.ingest_epoch(spark, lake, first, 0)
    if step is None:
        bs.ingest_epoch(spark, lake, second, 1)
    else:
        home = jobs if step == "merge_silver" else T
        own, calls = getattr(home, step), []

        def dies(*args, **kwargs):
            calls.append(1)
            if step == "merge_silver" or len(calls) > 1:
                raise ConnectionError("lost")
            return own(*args, **kwargs)

        monkeypatch.setattr(home, step, dies)
        with pytest.raises(ConnectionError):
            bs.ingest_epoch(spark, lake, second, 1)
        monkeypatch.undo()
    bs.ingest_epoch(spark, lake, second, 1)
    assert T.read_table(spark, lake.bronze_orders).count() == 5
    once = bronze_rows(spark, lake)
    bs.ingest_epoch(spark, lake, second, 1)
    assert bronze_rows(spark, lake) == once
    assert sm.bronze_of_batches(spark, lake, ["stream-bronze-000000000001"]).count() == 3
    assert T.read_table(spark, lake.silver_orders).count() == 2


def test_readers_never_see_half_a_publication(spark, lake_root, monkeypatch):
    folder = f"{lake_root}/_published/t"
    spark.sql("CREATE DATABASE IF NOT EXISTS pub")
    old, new = spark.range(3), spark.range(10)
    first = T.publish_version(spark, "pub.t", old, folder)
    monkeypatch.setattr(T, "switch_location", lambda *a: (_ for _ in ()).throw(ConnectionError("lost")))
    with pytest.raises(ConnectionError):
        T.publish_version(spark, "pub.t", new, folder)
    assert spark.table("pub.t").count() == 3 and T.table_location(spark, "pub.t").endswith(first.split("/")[-1])
    monkeypatch.undo()
    last = T.publish_version(spark, "pub.t", new, folder)
    assert spark.table("pub.t").count() == 10
    assert T.list_names(spark, folder) == [first.split("/")[-1], last.split("/")[-1]]  # what the dead one wrote is gone
    T.publish_version(spark, "pub.t", old, folder)
    assert spark.table("pub.t").count() == 3 and len(T.list_names(spark, folder)) == 2
    spark.sql("DROP DATABASE pub CASCADE")
