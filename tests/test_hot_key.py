"""A third of all rows on one key: results stay exact."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from orderlake.operators import quality as Q
from orderlake.operators.classify import class_counts, classify_changes
from orderlake.operators.staging import stage_latest, type_bronze
from orderlake.plans import registry as R


def _hot_bronze(spark):
    b = R.bronze(spark, SF_SMALL)
    # every returned line (about a third) collapses onto one key
    return b.withColumn("order_id", F.when(F.col("is_cancellation"), F.lit("HOT")).otherwise(F.col("order_id")))


def test_hot_key_staging_and_flags(spark):
    b = _hot_bronze(spark)
    hot_rows = b.filter("order_id = 'HOT'").count()
    total = b.count()
    assert hot_rows * 4 > total  # really hot
    staged = stage_latest(b, with_clock=False)
    assert staged.filter("order_id = 'HOT'").count() == 1
    expected_latest = b.filter("order_id = 'HOT'").agg(F.max(F.try_to_timestamp("updated_at"))).collect()[0][0]
    assert staged.filter("order_id = 'HOT'").collect()[0].updated_at == expected_latest
    typed = type_bronze(b)  # the checks are written for typed (Silver-shaped) rows
    res = {r.check_name: r.failed_count for r in Q.quality_results(typed, duplicate_keys=["order_id"]).collect()}
    dup_total = b.groupBy("order_id").count().filter("count > 1").agg(F.sum("count")).collect()[0][0]
    assert res["silver_no_duplicate_order_ids"] == dup_total
    flagged = Q.add_duplicate_flag(typed).filter(F.col(Q.DUPLICATE_FLAG)).count()
    assert flagged == dup_total


def test_hot_key_change_classes_cover_every_row(spark):
    b = _hot_bronze(spark)
    counts = {(r.change_class, r.is_late): r.row_count for r in class_counts(classify_changes(b, keys=["order_id"])).collect()}
    assert sum(counts.values()) == b.count()
    new_rows = sum(v for (c, _), v in counts.items() if c == "new")
    assert new_rows == b.select("order_id").distinct().count()


def _slow_classes(arrivals):
    """Row by row, in order; arrivals are (clock, batch, updated_at)."""
    best, out = None, []
    for _, batch, stamp in sorted(arrivals):
        out.append((batch, "new" if best is None else "correction" if stamp > best else "replay"))
        best = stamp if best is None else max(best, stamp)
    return out


@pytest.mark.parametrize("clocked", [True, False])
def test_one_key_in_100_000_batches(spark, clocked):
    """No window holds a key's batches: they are cut into hours, or into names that begin alike."""
    n = 100_000
    rows = spark.range(n, numPartitions=8).select(
        F.lit("hot").alias("order_id"),
        F.format_string("b%06d", "id").alias("batch_id"),
        F.date_format(F.timestamp_seconds(F.lit(1_300_000_000) + F.pmod(F.xxhash64("id"), F.lit(10_000_000)) + 40 * F.col("id")), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"),
        F.lit(None).cast("date").alias("event_date"),
        F.timestamp_seconds(F.lit(1_300_000_000) + 60 * F.col("id")).alias("ingested_at"),
    )
    rows = rows if clocked else rows.drop("ingested_at")
    found = classify_changes(rows)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    ordered = [w for w in plan.splitlines() if "Window" in w and "__u" in w]
    assert ordered and all("__block" in w for w in ordered)
    got = {(r.batch_id, r.change_class) for r in found.collect()}
    want = _slow_classes([(None, r.batch_id, r.updated_at) if not clocked else (r.ingested_at, r.batch_id, r.updated_at) for r in rows.collect()])
    assert got == set(want) and len({c for _, c in got}) == 3
