"""Declarative row-level quality checks: duplicate flag, one-pass results, rejects, gate.

A check is a Spark SQL predicate that is TRUE for a failing row. All checks are
evaluated in ONE aggregation pass (``count_if`` per check plus ``count(*)``), and
rejected rows come from ONE scan that tags each row with the checks it fails.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Severity = Literal["critical", "warning"]

DUPLICATE_FLAG = "__duplicate_order_id"


@dataclass(frozen=True)
class DataQualityCheck:
    name: str
    table_name: str
    severity: Severity
    description: str
    failure_expression: str


class DataQualityError(RuntimeError):
    """Raised by the quality job when a critical check fails (after results are written)."""


# --- Fixed values: the seven Silver checks (names, severities, texts, predicates) ---
SILVER_ORDER_CHECKS = (
    DataQualityCheck(
        name="silver_order_id_not_null",
        table_name="silver.orders",
        severity="critical",
        description="Every Silver order row must have a natural key.",
        failure_expression="order_id IS NULL OR trim(order_id) = ''",
    ),
    DataQualityCheck(
        name="silver_no_duplicate_order_ids",
        table_name="silver.orders",
        severity="critical",
        description="Silver must contain at most one current row per order_id.",
        failure_expression="__duplicate_order_id = true",
    ),
    DataQualityCheck(
        name="silver_updated_at_not_null",
        table_name="silver.orders",
        severity="critical",
        description="Every Silver row must have an updated_at timestamp for merge ordering.",
        failure_expression="updated_at IS NULL",
    ),
    DataQualityCheck(
        name="silver_quantity_not_zero",
        table_name="silver.orders",
        severity="critical",
        description="UCI rows can be positive sales or negative cancellations, but quantity should not be zero.",
        failure_expression="quantity = 0 OR quantity IS NULL",
    ),
    DataQualityCheck(
        name="silver_unit_price_non_negative",
        table_name="silver.orders",
        severity="critical",
        description="Unit price should not be negative.",
        failure_expression="unit_price < 0 OR unit_price IS NULL",
    ),
    DataQualityCheck(
        name="silver_invoice_no_present",
        table_name="silver.orders",
        severity="warning",
        description="Invoice number should be present for lineage back to the public dataset.",
        failure_expression="invoice_no IS NULL OR trim(invoice_no) = ''",
    ),
    DataQualityCheck(
        name="silver_country_present",
        table_name="silver.orders",
        severity="warning",
        description="Country should be populated for country-level Gold aggregations.",
        failure_expression="country IS NULL OR trim(country) = ''",
    ),
)
FRESHNESS_CHECK_NAME = "silver_freshness"
# --- end of fixed values ---


def check_names(checks: Sequence[DataQualityCheck] = SILVER_ORDER_CHECKS) -> list[str]:
    return [c.name for c in checks]


def add_duplicate_flag(df: DataFrame, keys: Sequence[str] = ("order_id",), flag: str = DUPLICATE_FLAG) -> DataFrame:
    """Flag every row whose key occurs more than once (NULL keys form one group).

    Counting is a ``groupBy`` (combined map-side before the shuffle); only keys seen
    more than once are joined back, null-safely. A window count would pull a hot key's
    rows into one task; the join lets adaptive execution split a skewed partition of the
    big side, or broadcast the keys by their measured size.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__key_rows")).filter(F.col("__key_rows") > 1)
    counts = counts.select(*[F.col(k).alias(f"__dup_{k}") for k in keys], "__key_rows")
    on = None
    for k in keys:
        cond = F.col(k).eqNullSafe(F.col(f"__dup_{k}"))
        on = cond if on is None else on & cond
    joined = df.join(counts, on, "left")
    return joined.select(*df.columns, F.col("__key_rows").isNotNull().alias(flag))


def uses_duplicate_flag(check: DataQualityCheck, flag: str = DUPLICATE_FLAG) -> bool:
    return flag in check.failure_expression


def counts_duplicates(check: DataQualityCheck, flag: str = DUPLICATE_FLAG) -> bool:
    """Does the check fail for exactly the flagged rows? Then key counts answer it."""
    return " ".join(check.failure_expression.lower().split()) in (flag, f"{flag} = true")


def quality_results(
    df: DataFrame,
    checks: Sequence[DataQualityCheck] = SILVER_ORDER_CHECKS,
    run_id: str | Column = "",
    created_at: Column | None = None,
    duplicate_keys: Sequence[str] | None = None,
) -> DataFrame:
    """A7 + P25/P26: one row per check, all counts from a single scan.

    ``df`` either carries the duplicate flag already, or ``duplicate_keys`` is given:
    then the duplicate check is counted WITHOUT flagging rows, as the sum of group
    sizes over keys seen more than once (a partial aggregate of the key columns),
    and the other checks come from one scan of ``df``. No join of the table with
    its key counts is needed for the results.

    Empty input gives ``total_count = 0``, status ``pass`` and rate 0.0.
    """
    if duplicate_keys is not None and any(uses_duplicate_flag(c) and not counts_duplicates(c) for c in checks):
        df, duplicate_keys = add_duplicate_flag(df, duplicate_keys), None  # the flag is part of a larger predicate
    if duplicate_keys is None:
        failed = [F.count_if(F.expr(c.failure_expression)).alias(f"__f{i}") for i, c in enumerate(checks)]
        counts = df.agg(*failed, F.count(F.lit(1)).alias("__total"))
    else:
        row_checks = [(i, c) for i, c in enumerate(checks) if not uses_duplicate_flag(c)]
        scan = df.agg(
            *[F.count_if(F.expr(c.failure_expression)).alias(f"__f{i}") for i, c in row_checks],
            F.count(F.lit(1)).alias("__total"),
        )
        in_dups = (
            df.groupBy(*duplicate_keys)
            .agg(F.count(F.lit(1)).alias("__n"))
            .agg(F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), F.lit(0)).alias("__dups"))
        )
        dups = in_dups.scalar()
        counts = scan.select(
            *[
                (F.col(f"__f{i}") if not uses_duplicate_flag(c) else dups).alias(f"__f{i}")
                for i, c in enumerate(checks)
            ],
            "__total",
        )
    rows = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("check_name"),
                F.lit(c.table_name).alias("table_name"),
                F.lit(c.severity).alias("severity"),
                F.col(f"__f{i}").cast("bigint").alias("failed_count"),
                F.lit(c.description).alias("description"),
                F.lit(c.failure_expression).alias("failure_expression"),
            )
            for i, c in enumerate(checks)
        ]
    )
    per_check = counts.select(F.inline(rows), F.col("__total").cast("bigint").alias("total_count"))
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    return per_check.select(
        run.alias("run_id"),
        "check_name",
        "table_name",
        "severity",
        F.when(F.col("failed_count") > 0, F.lit("fail")).otherwise(F.lit("pass")).alias("status"),
        "failed_count",
        "total_count",
        F.when(F.col("total_count") > 0, F.col("failed_count") / F.col("total_count"))
        .otherwise(F.lit(0.0))
        .alias("failure_rate"),
        "description",
        "failure_expression",
        (created_at if created_at is not None else F.current_timestamp()).alias("created_at"),
    )


def rejected_records(
    df: DataFrame,
    checks: Sequence[DataQualityCheck] = SILVER_ORDER_CHECKS,
    run_id: str | Column = "",
    with_clock: bool = True,
) -> DataFrame:
    """U1 + P24: every failing row once per failing check, tagged; one scan, no union.

    Gives the same bag as a union of one filter per check.
    """
    tags = F.array(
        *[
            F.when(F.expr(c.failure_expression), F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity")))
            for c in checks
        ]
    )
    hits = F.filter(tags, lambda t: t.isNotNull())
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    failing = F.lit(False)
    for c in checks:
        failing = failing | F.coalesce(F.expr(c.failure_expression), F.lit(False))
    exploded = df.filter(failing).withColumn("__hit", F.explode(hits))  # most rows fail no check: they build no tags
    cols = [*[F.col(c) for c in df.columns], run.alias("run_id"), F.col("__hit.check_name").alias("check_name"), F.col("__hit.severity").alias("severity")]
    if with_clock:
        cols.append(F.current_timestamp().alias("rejected_at"))
    return exploded.select(*cols)


def critical_failures(results: DataFrame) -> DataFrame:
    """the failing critical checks of a result set."""
    return results.filter((F.col("severity") == "critical") & (F.col("status") == "fail"))


def freshness_check(
    df: DataFrame,
    as_of: Column | str,
    hours: int = 24,
    ts_col: str = "event_time",
    table_name: str = "silver.orders",
    severity: Severity = "warning",
) -> DataFrame:
    """Table-level freshness, fails when the newest ``ts_col`` is older than ``hours``.

    ``as_of`` is a timestamp column expression (a literal or a scalar subquery), or the name of a column
    of ``df`` whose newest value it is: that takes no pass of its own.
    """
    newest = F.max(F.col(ts_col)).alias("last_event_time")
    if isinstance(as_of, str):
        latest, as_of = df.agg(newest, F.max(F.col(as_of)).alias("as_of")), F.col("as_of")
    else:
        latest = df.agg(newest)
    lag_hours = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("last_event_time"))) / F.lit(3_600_000_000.0)
    stale = F.coalesce(F.col("last_event_time") < as_of.cast("timestamp") - F.make_interval(hours=F.lit(hours)), F.lit(True))
    return latest.select(
        F.lit(FRESHNESS_CHECK_NAME).alias("check_name"),
        F.lit(table_name).alias("table_name"),
        F.lit(severity).alias("severity"),
        "last_event_time",
        as_of.cast("timestamp").alias("as_of"),
        lag_hours.alias("lag_hours"),
        F.when(stale, F.lit("fail")).otherwise(F.lit("pass")).alias("status"),
    )
