"""D1 for A1-A4: the business tables kept up to date from the rows that a merge changed.

A change is two signed images: the row as it was (-1) and as it is now (+1). Counts and sums follow
by adding signed values. A distinct count cannot: it needs to know when the last row of a value leaves
its group. A reference table holds, for each (group, column, value), the number of rows behind it, and
the distinct count moves by one where that number leaves or reaches zero.

Everything is addition of rows with equal keys (``unionByName`` and ``groupBy``), so NULL dates,
products and countries are groups like any others, no order of application matters, and sums are
combined before the shuffle. References are keyed by value too, so a group that holds a third of all
rows is spread over its values. They lie in ``BUCKETS`` folders by the hash of their group: a refresh
opens only the folders of groups that changed (``touched_buckets``).

``sum`` of no values is NULL in the rebuilt tables; the state therefore counts the values that are
not NULL beside each sum.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.operators.merge import ACTION_COL

BUCKETS = 64
REVENUE = "decimal(33,2)"

#: Columns of Silver that any business table reads.
IMAGE = ("event_date", "product_id", "product_name", "country", "order_status", "is_cancellation", "invoice_no", "customer_id", "quantity", "order_amount")
MEASURES = ("line_count", "net_units", "units_known", "net_revenue", "revenue_known", "cancellation_lines")


@dataclass(frozen=True)
class GoldTable:
    """Groups, distinct counts (output name and column) and outputs of a business table."""

    name: str
    groups: tuple[str, ...]
    distinct: tuple[tuple[str, str], ...]
    outputs: tuple[str, ...]


_INVOICES, _CUSTOMERS = ("invoice_count", "invoice_no"), ("customer_count", "customer_id")
GOLD_TABLES = (
    GoldTable("daily_sales", ("event_date",), (_INVOICES, _CUSTOMERS), ("invoice_count", "customer_count", "line_count", "net_units", "net_revenue", "cancellation_lines")),
    GoldTable("product_performance", ("product_id", "product_name"), (_INVOICES,), ("line_count", "invoice_count", "net_units", "net_revenue")),
    GoldTable("country_revenue", ("country",), (_INVOICES, _CUSTOMERS), ("line_count", "invoice_count", "customer_count", "net_revenue")),
    GoldTable("order_status_summary", ("order_status", "is_cancellation"), (_INVOICES,), ("line_count", "invoice_count", "net_units", "net_revenue")),
)


def as_inserts(silver: DataFrame) -> DataFrame:
    """Signed images of a first load: every row is new."""
    return silver.select(F.lit(1).alias("sign"), *IMAGE)


def signed_images(merged: DataFrame) -> DataFrame:
    """Old (-1) and new (+1) images of the rows that a merge inserted or updated.

    ``merged`` comes from ``merge_latest(..., track=IMAGE)``.
    """
    new = F.struct(F.lit(1).alias("sign"), *[F.col(c).alias(c) for c in IMAGE])
    old = F.struct(F.lit(-1).alias("sign"), *[F.col(f"_old_{c}").alias(c) for c in IMAGE])
    images = F.when(F.col(ACTION_COL) == "update", F.array(old, new)).otherwise(F.array(new))
    return merged.filter(F.col(ACTION_COL).isin("insert", "update")).select(F.inline(images))


def bucket_of(table: GoldTable) -> Column:
    return F.pmod(F.xxhash64(*table.groups), F.lit(BUCKETS)).cast("int")


def measure_deltas(table: GoldTable, signed: DataFrame) -> DataFrame:
    """Change of every count and sum of the groups that ``signed`` touches."""
    sign = F.col("sign")
    revenue = F.when(sign < 0, -F.col("order_amount")).otherwise(F.col("order_amount"))
    return signed.groupBy(*table.groups).agg(
        F.sum(sign).alias("line_count"),
        F.coalesce(F.sum(sign * F.col("quantity")), F.lit(0)).cast("bigint").alias("net_units"),
        F.sum(F.when(F.col("quantity").isNotNull(), sign).otherwise(0)).alias("units_known"),
        F.coalesce(F.sum(revenue), F.lit(0)).cast(REVENUE).alias("net_revenue"),
        F.sum(F.when(F.col("order_amount").isNotNull(), sign).otherwise(0)).alias("revenue_known"),
        F.sum(F.when(F.col("is_cancellation"), sign).otherwise(0)).alias("cancellation_lines"),
    )


def reference_deltas(table: GoldTable, signed: DataFrame) -> DataFrame:
    """Change of the rows behind each (group, output, value); values are text, NULL ones count for nothing."""
    values = F.array(*[F.struct(F.lit(out).alias("kind"), F.col(column).cast("string").alias("value")) for out, column in table.distinct])
    rows = signed.select("sign", *table.groups, F.inline(values)).filter("value is not null")
    changed = rows.groupBy(*table.groups, "kind", "value").agg(F.sum("sign").alias("rows")).filter("rows <> 0")
    return changed.withColumn("bucket", bucket_of(table))


def fold_references(table: GoldTable, references: DataFrame) -> DataFrame:
    """One row for each value that is still behind its group."""
    return references.groupBy(*table.groups, "kind", "value", "bucket").agg(F.sum("rows").alias("rows")).filter("rows <> 0")


def touched_buckets(deltas: DataFrame) -> list[int]:
    """Folders that hold the references of changed groups (at most ``BUCKETS`` numbers)."""
    return sorted(r[0] for r in deltas.select("bucket").distinct().collect())


def distinct_deltas(table: GoldTable, deltas: DataFrame, references: DataFrame | None) -> DataFrame:
    """Change of each distinct count: values that come to a group less those that leave it.

    Both sides meet by ``groupBy`` with a mark for the new side, so a value that did not change costs
    one partial sum and NULL groups meet their like. ``deltas`` have one row for each (group, output, value):
    without references there is nothing to meet.
    """
    keys = [*table.groups, "kind", "value"]
    now = deltas.select(*keys, F.lit(0).cast("bigint").alias("before"), F.col("rows").alias("change"))
    if references is not None:
        now = now.unionByName(references.select(*keys, F.col("rows").alias("before"), F.lit(0).cast("bigint").alias("change")))
        now = now.groupBy(*keys).agg(F.sum("before").alias("before"), F.sum("change").alias("change"))
    counts = now.filter("change <> 0")
    step = F.when((F.col("before") <= 0) & (F.col("before") + F.col("change") > 0), 1).when((F.col("before") > 0) & (F.col("before") + F.col("change") <= 0), -1).otherwise(0)
    per = counts.select(*table.groups, "kind", step.cast("bigint").alias("step"))
    return per.groupBy(*table.groups).agg(*[F.sum(F.when(F.col("kind") == out, F.col("step")).otherwise(0)).alias(out) for out, _ in table.distinct])


def add_up(table: GoldTable, parts: Sequence[DataFrame]) -> DataFrame:
    """The state after adding parts (states and deltas) up; groups without rows are gone."""
    names = [*MEASURES, *[out for out, _ in table.distinct]]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    zero = F.lit(0)
    sums = [F.sum(F.coalesce(F.col(n), zero)).cast(REVENUE if n == "net_revenue" else "bigint").alias(n) for n in names]
    return both.groupBy(*table.groups).agg(*sums).filter("line_count <> 0")


def next_state(
    table: GoldTable,
    signed: DataFrame,
    state: DataFrame | None = None,
    references: DataFrame | None = None,
    deltas: DataFrame | None = None,
    steps: DataFrame | None = None,
) -> DataFrame:
    """The state of a table after the changes ``signed`` (``deltas``: their reference deltas, if known; ``steps``:
    their ``distinct_deltas``, which may come in several rows of a group)."""
    if steps is None:
        steps = distinct_deltas(table, reference_deltas(table, signed) if deltas is None else deltas, references)
    parts = [measure_deltas(table, signed), steps]
    return add_up(table, parts if state is None else [state, *parts])


def published(table: GoldTable, state: DataFrame) -> DataFrame:
    """The business table itself, equal to one rebuilt from Silver."""
    units = F.when(F.col("units_known") > 0, F.col("net_units")).alias("net_units")
    revenue = F.when(F.col("revenue_known") > 0, F.col("net_revenue")).alias("net_revenue")
    shown = {"net_units": units, "net_revenue": revenue}
    return state.select(*table.groups, *[shown.get(c, F.col(c)) for c in table.outputs])
