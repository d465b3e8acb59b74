"""Mergeable distinct counts against counting the facts."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from orderlake.operators import distinct_bitmaps as db

SCHEMA = "day int, country string, customer string"


def facts(spark, seed, n=400, hot=False):
    pick = random.Random(seed)
    rows = [(pick.randint(0, 9) if not hot else pick.choice([0, 0, 1]), pick.choice(["UK", "FR", None]), pick.choice([None, "", *[f"c{k}" for k in range(90)]])) for _ in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def as_dict(df):
    return {tuple(r)[:-1]: tuple(r)[-1] for r in df.collect()}


def test_days_add_up(spark):
    rows = facts(spark, 1)
    state = db.bitmaps(rows, ["day", "country"], "customer", db.dictionary(rows, "customer"))
    for groups in (["day"], ["country"], ["day", "country"], []):
        want = as_dict(rows.groupBy(*groups).agg(F.count_distinct("customer")))
        assert as_dict(db.counts(db.rolled_up(state, groups), "n")) == {k: v for k, v in want.items() if v}


def test_numbers_are_dense_and_known_values_keep_theirs(spark):
    first, second = facts(spark, 2, 60), facts(spark, 3, 200)
    known = db.dictionary(first, "customer")
    known = spark.createDataFrame(known.collect(), known.schema)
    grown = db.extended(known, second, "customer")
    ids = as_dict(grown)
    assert sorted(ids.values()) == list(range(1, len(ids) + 1))
    assert as_dict(known).items() <= ids.items()
    assert as_dict(db.extended(known.limit(0), second, "customer")) == as_dict(db.dictionary(second, "customer"))
    both = db.merged(db.bitmaps(first, ["day"], "customer", known), db.bitmaps(second, ["day"], "customer", grown))
    assert as_dict(db.counts(both, "n")) == as_dict(first.unionByName(second).groupBy("day").agg(F.count_distinct("customer")))


def test_more_values_than_one_bucket_holds(spark):
    rows = spark.range(100_000).select((F.col("id") % 2).cast("int").alias("day"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("customer"))
    state = db.bitmaps(rows, ["day"], "customer", db.dictionary(rows, "customer"))
    assert state.count() == 8 and as_dict(db.counts(state, "n")) == {(0,): 50_000, (1,): 50_000}


def test_no_rows(spark):
    rows = facts(spark, 1).limit(0)
    assert db.counts(db.bitmaps(rows, ["day"], "customer", db.dictionary(rows, "customer")), "n").count() == 0


def test_thinly_spread_values_cost_a_word_each(spark):
    rows = spark.range(70_000).select((F.col("id") % 500).cast("int").alias("day"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("customer"))
    state = db.bitmaps(rows, ["day"], "customer", db.dictionary(rows, "customer"))
    assert state.count() == 1_500  # every day lies in all three buckets
    size = state.select(F.sum(F.length(F.to_json(F.struct("bitmap"))))).first()[0]
    assert size < 70_000 * 60  # whole bitmaps are 6 MB and more
    assert db.counts(db.rolled_up(state, []), "n").collect()[0][0] == 70_000


def test_sign_bit_and_last_bit_of_a_bucket(spark):
    rows = spark.range(32_770).select(F.lit(1).alias("day"), F.col("id").cast("string").alias("customer"))
    words = spark.range(32_770).select(F.col("id").cast("string").alias("value"), (F.col("id") + 1).alias("id"))
    assert as_dict(db.counts(db.rolled_up(db.bitmaps(rows, ["day"], "customer", words), ["day"]), "n")) == {(1,): 32_770}
    ends = rows.filter("customer in ('63', '32767', '32768')")
    assert as_dict(db.counts(db.merged(db.bitmaps(ends, ["day"], "customer", words), db.bitmaps(rows.limit(0), ["day"], "customer", words)), "n")) == {(1,): 3}
