"""Silver staging: type Bronze rows and keep the latest row per key (last writer wins)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from orderlake.sources.schemas import SILVER_COLUMNS

# Deterministic tie-break after the sequence column and the ingest clock. The
# reference leaves equal (updated_at, ingested_at) rows to chance; we order the
# remaining payload so repeated runs and other engines pick the same row. All of it:
# then every use of a staged table in one plan has the same rows before the window,
# whatever columns it goes on to read, and Spark shuffles them once for all.
TIEBREAK = (
    ("source_system", "desc"),
    ("quantity", "desc"),
    ("unit_price", "desc"),
    ("stock_code", "asc"),
    ("product_name", "asc"),
    ("customer_id", "asc"),
    ("country", "asc"),
    ("event_time", "asc"),
    ("invoice_no", "asc"),
    ("order_id", "asc"),
    ("source_file", "desc"),
    ("bronze_batch_id", "desc"),
    ("product_id", "asc"),
    ("order_status", "asc"),
    ("currency", "asc"),
    ("channel", "asc"),
    ("is_cancellation", "asc"),
    ("event_date", "asc"),
)


#: Why staging drops rows.
REASONS = ("null_key", "no_time", "unreadable_time")


def tiebreak_order(columns: Sequence[str]) -> list[Column]:
    out = []
    for name, direction in TIEBREAK:
        if name in columns:
            c = F.col(name)
            out.append(c.desc_nulls_last() if direction == "desc" else c.asc_nulls_last())
    return out


def type_bronze(bronze: DataFrame) -> DataFrame:
    """Drop the payload, parse times, cast quantity and price, compute the amount.

    ``try_`` casts turn bad values into NULL (Spark 4 runs in ANSI mode, where a plain
    cast would fail the job); rows whose ``updated_at`` is NULL are then dropped.
    """
    parsed = {
        "event_time": F.try_to_timestamp(F.col("event_time")),
        "updated_at": F.try_to_timestamp(F.col("updated_at")),
        "quantity": F.col("quantity").try_cast("int"),
        "unit_price": F.col("unit_price").try_cast("decimal(12,2)"),
    }
    renamed = {"batch_id": "bronze_batch_id", "ingested_at": "bronze_ingested_at"}
    cols = []
    for name in bronze.columns:
        if name == "raw_payload":
            continue
        # a column that only passes gets no alias: Spark keeps some of those, and then shuffles the same rows once for each use
        cols.append(parsed.get(name, F.col(name)).alias(renamed.get(name, name)) if name in parsed or name in renamed else F.col(name))
    amount = parsed["quantity"] * parsed["unit_price"]
    return bronze.select(*cols, amount.alias("order_amount"))


def drop_reason(keys: Sequence[str] = ("order_id",), seq: str = "updated_at") -> Column:
    """Why staging drops a Bronze row (F1, F2); NULL for rows it keeps."""
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    return F.when(no_key, F.lit("null_key")).when(F.col(seq).isNull(), F.lit("no_time")).when(F.try_to_timestamp(F.col(seq)).isNull(), F.lit("unreadable_time"))


def dropped_rows(bronze: DataFrame, keys: Sequence[str] = ("order_id",), seq: str = "updated_at") -> DataFrame:
    """The Bronze rows that staging drops, with their ``reason``."""
    return bronze.withColumn("reason", drop_reason(keys, seq)).filter("reason is not null")


def stage_latest(
    bronze: DataFrame,
    keys: Sequence[str] = ("order_id",),
    seq: str = "updated_at",
    then_by: Sequence[Column] | None = None,
    extra: Sequence[str] = (),
    with_clock: bool = True,
    dropped: Observation | None = None,
) -> DataFrame:
    """W1 + F1-F3 + P23: one row per key, the one with the greatest ``seq``.

    Order: ``seq`` desc, then ``then_by`` (default: newest ingest first), then the
    payload tie-break. ``row_number() == 1`` keeps the shape Spark turns into a
    partial WindowGroupLimit before the shuffle, so hot keys shrink map-side.
    ``dropped`` is told the rows that are dropped for each of ``REASONS``, by the action
    that runs the result.
    """
    if dropped is not None:
        reason = drop_reason(keys, seq)
        bronze = bronze.observe(dropped, *[F.count_if(F.coalesce(reason == r, F.lit(False))).alias(r) for r in REASONS])
    typed = type_bronze(bronze).drop("order_amount")
    if then_by is None:
        then_by = [F.col("bronze_ingested_at").desc_nulls_last()]
    order = [F.col(seq).desc_nulls_last(), *then_by, *tiebreak_order(typed.columns)]
    window = Window.partitionBy(*keys).orderBy(*order)
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    latest = (
        typed.filter(not_null & F.col(seq).isNotNull())
        .withColumn("__rn", F.row_number().over(window))
        .filter(F.col("__rn") == 1)
    )
    amount = (F.col("quantity") * F.col("unit_price")).alias("order_amount")
    silver_cols = [c for c in SILVER_COLUMNS if c != "silver_updated_at"]
    cols = [amount if c == "order_amount" else F.col(c) for c in silver_cols]
    if with_clock:
        cols.append(F.current_timestamp().alias("silver_updated_at"))
    passthrough = [c for c in [*keys, *extra] if c not in SILVER_COLUMNS]
    return latest.select(*cols, *[F.col(c) for c in dict.fromkeys(passthrough)])
