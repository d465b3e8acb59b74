"""Change classes: one shuffle of whole rows, equal to a row by row pass over random arrivals."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from fixtures import B1, B2, bronze_batch
from orderlake.operators.classify import classify_changes


def test_change_classes_shuffle_whole_rows_once(spark):
    found = classify_changes(bronze_batch(spark, B1, "b1", "2010-12-02T00:00:00Z").unionByName(bronze_batch(spark, B2, "b2", "2010-12-03T00:00:00Z")))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    wide = [line for line in plan.splitlines() if "Exchange" in line and "REPARTITION_BY_COL" in line and "ReusedExchange" not in line]
    assert len(wide) == 1 and "ReusedExchange" in plan


def _classes(rows):
    """Row by row; rows are (key, batch, at, detail, clock)."""
    copies, clock = Counter(r[:4] for r in rows), {}
    for key, batch, _, _, when in rows:
        if when is not None:
            clock[key, batch] = min(when, clock.get((key, batch), when))
    best, last, out = {}, {}, Counter()
    none = lambda x: (x is not None, x or 0)
    for key, batch, at, detail in sorted(copies, key=lambda r: (r[0], none(clock.get(r[:2])), none(r[1] and r[1].ljust(9)), r[2], r[3])):
        n, own = copies[key, batch, at, detail], (key, batch, at)
        if last.get(key) == own:
            out[own, detail, "replay", n] += 1
        else:
            kind = "new" if key not in best else "correction" if at > best[key] else "replay"
            out[own, detail, kind, 1] += 1
            if n > 1:
                out[own, detail, "replay", n - 1] += 1
        last[key], best[key] = own, max(at, best.get(key, at))
    return out


def test_change_classes_of_random_arrivals(spark):
    pick = random.Random(7)
    start = dt.datetime(2011, 1, 1)
    rows = [
        (f"k{pick.randint(0, 12)}", pick.choice([None, "b1", "b2", "b3", "b4", "b5"]), start + dt.timedelta(days=pick.randint(0, 4)), pick.randint(0, 1), pick.choice([None, *[start + dt.timedelta(minutes=25 * k) for k in range(9)]]))
        for _ in range(600)
    ]
    df = spark.createDataFrame(rows, "order_id string, batch_id string, updated_at timestamp, quantity int, ingested_at timestamp").withColumn("event_date", F.lit(None).cast("date"))
    got = Counter(((r.order_id, r.batch_id, r.updated_at), r.quantity, r.change_class, r.row_count) for r in classify_changes(df.repartition(5)).collect())
    assert got == _classes(rows)
