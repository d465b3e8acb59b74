"""Merges that are indexed, journaled and fed to Gold: equal to a rebuild, whatever dies on the way."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from orderlake.operators import gold as G
from orderlake.operators import gold_delta as D
from orderlake.plans import gold_refresh as gr
from orderlake.plans import jobs
from orderlake.plans import silver_merge as sm
from orderlake.sources import tables as T
from orderlake.sources.schemas import LANDING_SCHEMA

DAYS = [dt.date(2011, 1, d) for d in range(1, 9)]


def landing(seed, n=60, day=1):
    """Arrivals of one day: few keys, so that rows move between dates, products, customers; some dates are unknown."""
    pick = random.Random(seed)
    rows = []
    for k in range(n):
        key = pick.randint(0, 80)
        when = None if pick.random() < 0.1 else f"{pick.choice(DAYS).isoformat()}T08:00:00Z"
        product = pick.choice(["P1", "P2", None])
        cancelled = pick.random() < 0.3
        rows.append((
            f"k{key}", pick.choice(["i1", "i2", "i3", None]), product, pick.choice(["c1", "c2", "", None]), product, pick.choice(["Lamp", "Cup"]),
            "cancelled" if cancelled else "completed", pick.choice([None, 1, 2, -3]), pick.choice(["1.50", "2.25", "bad"]), "GBP", "online_retail", pick.choice(["UK", "FR", None]),
            cancelled, when, f"2011-02-{day:02d}T{pick.randint(0, 23):02d}:00:00Z", "test",
        ))
    return rows


def ingest(spark, lake, day):
    jobs.ingest_bronze(spark, lake, f"b{day}", spark.createDataFrame(landing(day, day=day), LANDING_SCHEMA))


def run(spark, lake, day):
    ingest(spark, lake, day)
    return jobs.merge_silver(spark, lake, f"s{day}", batch_ids=[f"b{day}"])


def gold_of(spark, lake):
    return {t.name: sorted(map(str, T.read_table(spark, lake.gold(t.name)).drop("gold_updated_at").collect())) for t in D.GOLD_TABLES}


def rebuilt(spark, lake):
    silver = spark.read.parquet(lake.silver_orders)
    frames = G.business_tables(silver, with_clock=False)
    return {t.name: sorted(map(str, frames[t.name].select(*t.groups, *t.outputs).collect())) for t in D.GOLD_TABLES}


def in_order(spark, lake):
    """The columns of a refreshed table are those of a rebuilt one."""
    frames = G.business_tables(spark.read.parquet(lake.silver_orders))
    for name, frame in frames.items():
        assert T.read_table(spark, lake.gold(name)).dtypes == frame.dtypes


def test_gold_follows_the_feed_and_equals_a_rebuild(spark, lake_root):
    lake = T.Lake(lake_root, "parquet")
    for day in range(1, 5):
        run(spark, lake, day)
        jobs.build_gold_tables(spark, lake, f"g{day}")
        assert gold_of(spark, lake) == rebuilt(spark, lake)
        assert gr.last_commit(spark, lake)["load"] == max(sm.loads(spark, lake), default=0) == day - 1
    in_order(spark, lake)
    assert None in {r.event_date for r in T.read_table(spark, lake.gold("daily_sales")).collect()}
    run(spark, lake, 5)  # two loads at once, after a refresh that wrote but did not commit
    run(spark, lake, 6)
    commit = gr.last_commit(spark, lake)
    gr.refresh(spark, lake)
    T.delete_path(spark, lake.gold_state("commits", f"{commit['version'] + 1:012d}.json"))
    assert gr.last_commit(spark, lake) == commit
    if not T.path_exists(spark, lake.gold_state("state", f"version={commit['version']}")):
        pytest.fail("the state of the last commit is needed for the retry")
    jobs.build_gold_tables(spark, lake, "g6")
    assert gold_of(spark, lake) == rebuilt(spark, lake)
    before = gold_of(spark, lake)
    jobs.build_gold_tables(spark, lake, "again")  # nothing new
    jobs.build_gold_tables(spark, lake, "anew", rebuild=True)
    assert gold_of(spark, lake) == before


def test_references_fold(spark, lake_root, monkeypatch):
    monkeypatch.setattr(gr, "FOLD", 2)
    lake = T.Lake(lake_root, "parquet")
    for day in range(1, 5):
        run(spark, lake, day)
        jobs.build_gold_tables(spark, lake, f"g{day}")
        assert gold_of(spark, lake) == rebuilt(spark, lake)
        assert len(gr.last_commit(spark, lake)["references"]) <= 2
    names = T.list_names(spark, lake.gold_state("references", "daily_sales"))
    assert [f"load={n}" for n in gr.last_commit(spark, lake)["references"]] == [n for n in names if n.startswith("load=")]


def silver_rows(spark, lake):
    return sorted(map(str, spark.read.parquet(lake.silver_orders).drop("silver_updated_at", "bronze_ingested_at").collect()))


@pytest.mark.parametrize("step", ["overwrite_partitions", "delete_path", "list_names", "signed_images", "key_hash"])
def test_a_merge_that_dies_is_finished_by_the_next(spark, lake_root, monkeypatch, step):
    whole, lake = T.Lake(f"{lake_root}/whole", "parquet"), T.Lake(f"{lake_root}/dies", "parquet")
    for one in (whole, lake):
        run(spark, one, 1)
        for day in (2, 3):
            ingest(spark, one, day)
    jobs.merge_silver(spark, whole, "s2", batch_ids=["b2"])
    jobs.merge_silver(spark, whole, "s3", batch_ids=["b3"])

    applying = []
    apply = sm.apply

    def applied(*args):
        applying.append(1)
        return apply(*args)

    home = T if hasattr(T, step) else sm
    own = getattr(home, step)

    def dies(*args, **kwargs):
        if applying:
            raise ConnectionError("lost")
        return own(*args, **kwargs)

    monkeypatch.setattr(sm, "apply", applied)
    monkeypatch.setattr(home, step, dies)
    with pytest.raises(ConnectionError):
        jobs.merge_silver(spark, lake, "s2", batch_ids=["b2"])
    monkeypatch.undo()
    assert len(T.list_names(spark, lake.journal)) >= 1
    jobs.merge_silver(spark, lake, "s3", batch_ids=["b3"])
    assert silver_rows(spark, lake) == silver_rows(spark, whole)
    assert sm.loads(spark, lake) == [1, 2] and not [n for n in T.list_names(spark, lake.journal) if n.endswith("json")]
    jobs.build_gold_tables(spark, lake, "g")
    assert gold_of(spark, lake) == rebuilt(spark, lake)


def test_a_journal_without_its_rows_is_an_error(spark, lake_root):
    lake = T.Lake(lake_root, "parquet")
    run(spark, lake, 1)
    T.write_small(spark, f"{lake.journal}/{1:012d}.json", json.dumps({"load": 1, "staging": f"{lake_root}/nowhere", "columns": [], "keys": [], "dates": []}))
    with pytest.raises(FileNotFoundError):
        run(spark, lake, 2)


def test_a_merge_opens_only_candidate_partitions(spark, lake_root):
    lake = T.Lake(lake_root, "parquet")
    run(spark, lake, 1)
    silver = spark.read.parquet(lake.silver_orders)
    row = silver.filter("event_date is not null").limit(1).collect()[0]
    source = silver.filter(F.col("order_id") == row.order_id).withColumn("event_date", F.lit(dt.date(2012, 5, 5)))
    dates = sm.candidate_dates(spark, lake, source, ["order_id"])
    assert set(dates) == {row.event_date, dt.date(2012, 5, 5)}
    target = sm.target_of(spark, lake, dates)
    plan = target._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r[0] for r in target.select("event_date").distinct().collect()} == {row.event_date}
    assert sm.target_of(spark, lake, [None]).filter("event_date is not null").isEmpty()


def test_stale_index_entries_do_no_harm(spark, lake_root):
    lake = T.Lake(lake_root, "parquet")
    for day in range(1, 4):
        run(spark, lake, day)
    index = spark.read.parquet(lake.index(sm.KEY_INDEX)).select("h", "event_date").distinct()
    keys = spark.read.parquet(lake.silver_orders).select(sm.key_hash(["order_id"]), "event_date")
    assert keys.exceptAll(index).isEmpty()
    before = silver_rows(spark, lake)
    sm.build_key_index(spark, lake, ["order_id"])
    assert sorted(map(str, spark.read.parquet(lake.index(sm.KEY_INDEX)).select("h", "event_date").collect())) == sorted(map(str, keys.collect()))
    jobs.merge_silver(spark, lake, "again", batch_ids=["b1", "b2", "b3"])
    assert silver_rows(spark, lake) == before


def test_one_batch_among_many_prunes_bronze(spark, lake_root):
    lake = T.Lake(lake_root, "parquet")
    for day in range(1, 4):
        ingest(spark, lake, day)
    rows = sm.bronze_of_batches(spark, lake, ["b2"])
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString().lower()
    every = T.read_table(spark, lake.bronze_orders).filter("batch_id = 'b2'")
    assert rows.columns == every.columns
    assert rows.exceptAll(every).isEmpty() and every.exceptAll(rows).isEmpty() and not rows.filter("event_date is null").isEmpty()
    T.delete_path(spark, f"{lake.index(sm.BATCH_INDEX)}/batch_id=b2")  # as if written before there was an index
    assert sm.bronze_of_batches(spark, lake, ["b2", "b3"]).count() == every.count() + T.read_table(spark, lake.bronze_orders).filter("batch_id = 'b3'").count()
