"""Exact distinct counts that add up: A1, A3 and A8 for longer periods, without the facts.

A distinct count of a month is not the sum of its days'. The state kept here can be merged: values get
dense numbers from a dictionary, and each (group, bucket of 32,768 numbers) has one bitmap with a bit for
each value seen. Bitmaps of several groups are joined by OR, and their bits counted; so months come from days,
countries from (country, month), and the whole from anything. A bitmap is kept as its words of 64 bits that are
not zero, at most 512 of them: a group whose values are spread thinly over the numbers costs a word for each
value, not 4 KB for each bucket that it touches. Words are OR-ed one by one, as numbers, before they are packed.

Numbers are dealt without a global sort: values are numbered inside ``PARTS`` hash parts and the parts
follow each other (``PARTS`` rows know where each begins). They are a function of the values alone, so a
recomputed task deals them again. A dictionary grows by ``extended``: known values keep their numbers, so
old bitmaps stay good. A group that holds a third of all rows is one row for each bucket and task before
the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PARTS = 256


def _numbered(values: DataFrame, start: Column | int = 1) -> DataFrame:
    # never NULL, and Spark knows: it would look for NULLs among the rows themselves, and shuffle them once more for that
    parted = values.withColumn("part", F.coalesce(F.pmod(F.xxhash64("value"), F.lit(PARTS)), F.lit(0)))
    placed = parted.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy("value")))
    sizes = parted.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    begin = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # PARTS rows at most
    begins = sizes.select("part", begin.alias("begin"))
    start = start if isinstance(start, Column) else F.lit(start)
    return placed.join(begins, "part").select("value", (start + F.col("begin") + F.col("place") - 1).cast("bigint").alias("id"))


def _values(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(F.col(column).cast("string").alias("value")).filter("value is not null").distinct()


def dictionary(rows: DataFrame, column: str) -> DataFrame:
    """``value`` and ``id`` (dense, from 1: a bitmap bucket begins after a multiple of 32,768) of each distinct value that is not NULL."""
    return _numbered(_values(rows, column))


def extended(known: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """The dictionary with the values of ``rows`` that it lacks, numbered after its own."""
    new = _values(rows, column).join(known.select("value"), "value", "left_anti")
    start = known.agg(F.coalesce(F.max("id") + 1, F.lit(1))).scalar()
    return known.unionByName(_numbered(new, start))


def bitmaps(rows: DataFrame, groups: Sequence[str], column: str, words: DataFrame) -> DataFrame:
    """State: one row for each group and bucket, with the bits of the values of ``column`` seen there."""
    seen = rows.select(*groups, F.col(column).cast("string").alias("value")).filter("value is not null").distinct()
    coded = seen.join(words, "value").select(*groups, F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").alias("position"))
    bits = coded.select(*groups, "bucket", F.expr("cast(shiftright(position, 6) as smallint)").alias("word"), F.expr("shiftleft(1L, cast(position & 63 as int))").alias("bits"))
    return _packed(bits, groups)


def _packed(words: DataFrame, groups: Sequence[Column | str]) -> DataFrame:
    """Bitmaps of ``word`` and ``bits`` rows; equal words are OR-ed."""
    whole = words.groupBy(*groups, "bucket", "word").agg(F.bit_or("bits").alias("bits"))
    names = [c for c in whole.columns if c not in ("word", "bits")]
    return whole.groupBy(*names).agg(F.collect_list(F.struct("word", "bits")).alias("bitmap"))


def rolled_up(state: DataFrame, groups: Sequence[Column | str]) -> DataFrame:
    """The state of coarser groups (columns or expressions of the state's groups)."""
    return _packed(state.select(*[c for c in state.columns if c != "bitmap"], F.inline("bitmap")), groups)


def merged(*states: DataFrame) -> DataFrame:
    """One state of several with the same groups, for example of a new day and of those before."""
    every = states[0]
    for state in states[1:]:
        every = every.unionByName(state)
    return rolled_up(every, [c for c in every.columns if c not in ("bucket", "bitmap")])


def counts(state: DataFrame, name: str) -> DataFrame:
    """Distinct values of each group."""
    groups = [c for c in state.columns if c not in ("bucket", "bitmap")]
    bits = F.aggregate("bitmap", F.lit(0).cast("bigint"), lambda total, w: total + F.bit_count(w["bits"]))
    return state.groupBy(*groups).agg(F.sum(bits).alias(name))
