"""Large writes of the lake run in passes over shares of the keys: the same tables, with less shuffled at a time."""

from __future__ import annotations

from pyspark.sql import functions as F

from fixtures import B1, bronze_batch
from orderlake.operators.staging import stage_latest
from orderlake.plans import gold_refresh as gr
from orderlake.plans import jobs
from orderlake.plans import silver_merge as sm
from orderlake.sources import tables as T
from orderlake.sources.schemas import LANDING_SCHEMA
from test_incremental import gold_of, landing, rebuilt, silver_rows


def small_passes(monkeypatch):
    monkeypatch.setattr(T, "PASS_ROWS", 40, raising=False)


def two_loads(spark, lake):
    for day in (1, 2):
        rows = [*landing(day, day=day), (None, *landing(9, 1)[0][1:]), (*landing(8, 1)[0][:14], "no time", "test")]
        jobs.ingest_bronze(spark, lake, f"b{day}", spark.createDataFrame(rows, LANDING_SCHEMA))
        yield day, jobs.merge_silver(spark, lake, f"s{day}", batch_ids=[f"b{day}"])


def dropped(spark, lake):
    return sorted((r.run_id, r.reason) for r in T.read_table(spark, lake.quarantine).collect())


def log(spark, lake):
    return sorted((r.run_id, r.row_count, r.message.split("; ")[-1]) for r in T.read_table(spark, lake.run_log).filter("pipeline_step = 'silver_orders'").collect())


def test_passes_write_the_same_lake(spark, lake_root, monkeypatch):
    plain, lake = T.Lake(f"{lake_root}/plain", "parquet"), T.Lake(f"{lake_root}/passes", "parquet")
    staged = dict(two_loads(spark, plain))
    small_passes(monkeypatch)
    monkeypatch.setattr(gr, "FOLD", 1)
    met, left, merge_latest, apply = [], [], sm.merge_latest, sm.apply

    def counted(target, source, **kwargs):
        met.append((target.count(), source.count()))
        return merge_latest(target, source, **kwargs)

    def applied(spark, lake, plan):
        left.append(T.list_names(spark, plan["staging"]))
        return apply(spark, lake, plan)

    monkeypatch.setattr(sm, "merge_latest", counted)
    monkeypatch.setattr(sm, "apply", applied)
    for day, rows in two_loads(spark, lake):
        assert rows == staged[day]
        jobs.build_gold_tables(spark, lake, f"g{day}")
        assert gold_of(spark, lake) == rebuilt(spark, lake)
    everything = spark.read.parquet(lake.silver_orders)
    assert len(met) > 1 and max(a + b for a, b in met) < everything.count()  # no pass meets all rows
    assert left == [["merged"]]  # what was merged is gone before Silver is written a second time
    assert silver_rows(spark, lake) == silver_rows(spark, plain)
    assert dropped(spark, lake) == dropped(spark, plain) and log(spark, lake) == log(spark, plain)
    assert everything.groupBy("bronze_batch_id").agg(F.countDistinct("silver_updated_at").alias("n")).filter("n > 1").isEmpty()
    for n in sm.loads(spark, plain):
        images = [sorted(map(str, spark.read.parquet(f"{one.changes}/load={n}").collect())) for one in (plain, lake)]
        assert images[0] == images[1]
    assert not T.list_names(spark, lake.gold_state("steps")) and not T.path_exists(spark, f"{lake.silver_orders}-new")


def test_a_share_is_taken_before_the_shuffle(spark):
    staged = stage_latest(bronze_batch(spark, B1, "b1", "2010-12-02T00:00:00Z"))
    plan = T.share(staged, ["order_id"], 0, 2)._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.splitlines() if "Exchange" in line or "xxhash64(order_id" in line]
    assert "xxhash64" in lines[-1] and "Exchange" in lines[0], plan


def test_shares_are_all_rows_once(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 10 > 0, F.col("id").cast("string")).alias("k"))
    assert sum(T.share(rows, ["k"], k, 3).count() for k in range(3)) == 1000
    assert T.passes(0) == T.passes(T.PASS_ROWS) == 1 and T.passes(T.PASS_ROWS + 1) == 2 and T.passes(10**12) == T.MOST_PASSES
