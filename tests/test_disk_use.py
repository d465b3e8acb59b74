"""What the jobs write and shuffle: landing is compressed, images are carried only where they count."""

from __future__ import annotations

import glob
import os

from pyspark.sql import functions as F

from fixtures import B1, bronze_batch
from orderlake.operators import gold_delta as gd
from orderlake.plans import jobs
from orderlake.session import SHORT_SHUFFLES, settings
from orderlake.sources import tables as T
from orderlake.sources.schemas import LANDING_COLUMNS, LANDING_SCHEMA


def test_landing_is_compressed_and_read_back_whole(spark, lake_root):
    lake = T.Lake(lake_root, "parquet")
    events = spark.createDataFrame(B1, LANDING_SCHEMA)
    T.write_landing(events, lake, F.lit("2010-12-01").cast("date"), F.lit("b"))
    files = glob.glob(f"{lake.landing}/event_date=2010-12-01/batch_id=b/*.json*")
    assert files and all(f.endswith(".gz") for f in files)
    back = T.read_landing(spark, lake.landing).select(*LANDING_COLUMNS)
    assert sorted(map(str, back.collect())) == sorted(map(str, events.collect()))
    assert jobs.ingest_bronze(spark, lake, "b1", source=f"{lake.landing}/event_date=2010-12-01/batch_id=b") == len(B1)
    bronze = T.read_table(spark, lake.bronze_orders)
    want = bronze_batch(spark, B1, "b1", "2010-12-02T00:00:00Z")
    columns = [*LANDING_COLUMNS, "raw_payload", "batch_id", "event_date"]
    assert sorted(map(str, bronze.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
    assert {os.path.basename(p) for p in glob.glob(f"{lake.bronze_orders}/event_date=*")} == {"event_date=2010-12-01"}


def test_settings_come_back(spark):
    key = next(iter(SHORT_SHUFFLES))
    before = spark.conf.get(key)
    with settings(spark, {**SHORT_SHUFFLES, "orderlake.unknown": "1"}):
        assert spark.conf.get(key) == "true" and spark.conf.get("orderlake.unknown") == "1"
    assert spark.conf.get(key) == before and spark.conf.get("orderlake.unknown", None) is None


def test_files_of_one_date_are_copied_without_a_shuffle(spark, lake_root):
    rows = spark.range(1000, numPartitions=4).selectExpr("id", "date_add(date'2011-01-01', cast(id % 5 as int)) as event_date", "id as a")
    T.rebalanced(rows.withColumn("__date", F.col("event_date")), "__date").write.partitionBy("__date").parquet(f"{lake_root}/merged")
    rows.filter("id < 10").withColumn("a", F.lit(-1).cast("bigint")).write.partitionBy("event_date").parquet(f"{lake_root}/silver")
    spark.range(1).selectExpr("id", "date'2012-01-01' as event_date", "id as a").write.mode("append").partitionBy("event_date").parquet(f"{lake_root}/silver")
    merged = spark.read.parquet(f"{lake_root}/merged").select("id", "event_date", "a")
    T.overwrite_partitions(merged, f"{lake_root}/silver", grouped=True)
    back = spark.read.parquet(f"{lake_root}/silver")
    assert back.filter("event_date < '2012-01-01'").select("id", "event_date", "a").exceptAll(merged).count() == 0 and back.count() == 1001
    assert len(glob.glob(f"{lake_root}/silver/event_date=2011*/*.parquet")) == len(glob.glob(f"{lake_root}/merged/*/*.parquet"))


def test_landing_of_few_folders_is_not_shuffled(spark, lake_root):
    lake = T.Lake(lake_root, "parquet")
    events = spark.createDataFrame(B1, LANDING_SCHEMA).repartition(2).localCheckpoint()
    T.write_landing(events, lake, F.lit("2010-12-01").cast("date"), F.when(F.col("order_id") == "A", F.lit("a")).otherwise(F.lit("b")), few=True)
    back = T.read_landing(spark, lake.landing)
    assert sorted(map(str, back.select(*LANDING_COLUMNS).collect())) == sorted(map(str, events.collect()))
    assert {(r.order_id == "A", r.batch_id) for r in back.collect()} == {(True, "a"), (False, "b")}


def test_first_counts_of_distinct_values_need_no_second_shuffle(spark):
    rows = spark.createDataFrame([("UK", "i1", "c1"), ("UK", "i1", "c2"), (None, "i2", None)], "country string, invoice_no string, customer_id string")
    table = next(t for t in gd.GOLD_TABLES if t.name == "country_revenue")
    found = gd.distinct_deltas(table, gd.reference_deltas(table, rows.withColumn("sign", F.lit(1))), None)
    assert {(r.country, r.invoice_count, r.customer_count) for r in found.collect()} == {("UK", 1, 2), (None, 1, 0)}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2
