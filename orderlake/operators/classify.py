"""Classify every Bronze arrival as ``new``, ``correction`` or ``replay`` per key.

Ingest order is: batch by its ingest clock (``ingested_at``, where the rows have it),
then by name; inside a batch ``updated_at`` ascending, then the payload. Per key, the first row is ``new``; a later row is
a ``correction`` when its ``updated_at`` is strictly greater than every earlier
row's, else a ``replay``. ``is_late`` marks rows whose update date is after their
business date.

Scale: whole rows are shuffled once, by (key, batch), and no task gathers a key's rows, or its batches. There
copies are collapsed as they stream in, and a row needs to know only the one before it in its batch and
the greatest ``updated_at`` of the key's earlier batches. That maximum is worked out from one narrow row for each
(key, batch), and blocked: rows are ordered and compared inside (key, block), a block being an hour of the ingest
clock (without a clock: the names that share all but their last two characters); the maxima of the blocks,
one row for each (key, block), get a running maximum of their own. Only what has something earlier is
joined back. Output is one row per distinct arrival and class with its ``row_count``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Payload fields that tell two arrivals of one key apart, in tie-break order.
DETAIL = (
    "source_system",
    "quantity",
    "unit_price",
    "stock_code",
    "product_name",
    "customer_id",
    "country",
    "event_time",
    "invoice_no",
    "order_id",
)
#: Seconds of the block of rows without a clock, before that of any clock.
NO_CLOCK = -(10**11)


def classify_changes(
    df: DataFrame,
    keys: Sequence[str] = ("order_id",),
    batch_col: str = "batch_id",
    seq: str = "updated_at",
) -> DataFrame:
    seq_type = df.schema[seq].dataType
    seq_ts = F.try_to_timestamp(F.col(seq)) if isinstance(seq_type, StringType) else F.col(seq).cast("timestamp")
    detail = [c for c in DETAIL if c in df.columns and c not in keys and c != seq]
    valid = F.col(seq).isNotNull()
    for k in keys:
        valid = valid & F.col(k).isNotNull()

    clocked = "ingested_at" in df.columns
    clock = F.col("ingested_at") if clocked else F.lit(None).cast("timestamp")
    # a NULL batch is a batch of its own: by a name and a mark, so that joins are plain ones
    batch = [*keys, "__batch", "__unnamed"]
    rows = df.select(
        *keys, F.coalesce(F.col(batch_col), F.lit("")).alias("__batch"), F.col(batch_col).isNull().alias("__unnamed"), seq_ts.alias("__at"), "event_date", *detail, clock.alias("__clock")
    ).filter(F.col("__at").isNotNull() & valid)
    rows = rows.repartition(*batch)
    once = rows.groupBy(*batch, "__at", "event_date", *detail).agg(F.count(F.lit(1)).alias("__copies"), F.min("__clock").alias("__clock"))
    # the clock orders nothing here, but with it both uses of the shuffled rows read the same columns: one shuffle
    placed = once.withColumn("__last", F.lag("__at").over(Window.partitionBy(*batch).orderBy("__at", *detail, "event_date", "__clock")))

    # a batch's place is its first clock among the key's rows
    tops = once.groupBy(*batch).agg(F.max("__at").alias("__u"), F.min("__clock").alias("__clock"))
    if clocked:
        block, none = F.date_trunc("hour", "__clock"), F.timestamp_seconds(F.lit(NO_CLOCK))
    else:  # names of one length more or less: all but two characters, the same number for every name
        width = df.agg(F.greatest(F.max(F.length(batch_col)) - 2, F.lit(1))).scalar()
        block, none = F.substring(F.col("__batch"), F.lit(1), width), F.lit("")
    tops = tops.withColumn("__block", F.coalesce(block, none))

    inside = Window.partitionBy(*keys, "__block").orderBy("__clock", F.col("__unnamed").desc(), "__batch")
    tops = tops.withColumns({"__before": F.max("__u").over(inside.rowsBetween(Window.unboundedPreceding, -1)), "__more": F.lead(F.lit(True)).over(inside)})
    blocks = tops.filter("__more is null").select(*keys, "__block", F.greatest("__before", "__u").alias("__top"))  # the last batch of each block
    earlier = F.max("__top").over(Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.withColumn("__earlier", earlier).drop("__top").filter("__earlier is not null")
    beaten = tops.join(blocks, [*keys, "__block"], "left").select(*batch, F.greatest("__before", "__earlier").alias("__beaten")).filter("__beaten is not null")
    joined = placed.join(beaten, batch, "left")

    first = F.col("__beaten").isNull() & F.col("__last").isNull()  # nothing came before
    lead = F.when(first, F.lit("new")).when(F.col("__beaten").isNull() | (F.col("__at") > F.col("__beaten")), F.lit("correction")).otherwise(F.lit("replay"))
    one = F.struct(lead.alias("change_class"), F.lit(1).cast("bigint").alias("row_count"))
    rest = F.struct(F.lit("replay").alias("change_class"), (F.col("__copies") - 1).alias("row_count"))
    whole = F.struct(F.lit("replay").alias("change_class"), F.col("__copies").alias("row_count"))
    again = F.coalesce(F.col("__last") == F.col("__at"), F.lit(False))
    parts = F.when(again, F.array(whole)).otherwise(F.array(one, rest))
    name = F.when(~F.col("__unnamed"), F.col("__batch")).alias(batch_col)
    out = joined.select(*keys, name, F.col("__at").alias(seq), "event_date", *detail, F.inline(parts)).filter("row_count > 0")
    return out.withColumn("is_late", F.to_date(F.col(seq)) > F.col("event_date"))


def class_counts(classified: DataFrame) -> DataFrame:
    """Rows per class and lateness (a small report over ``classify_changes``)."""
    return classified.groupBy("change_class", "is_late").agg(F.sum("row_count").alias("row_count"))
