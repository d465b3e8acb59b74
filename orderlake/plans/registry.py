"""Named queries over the star-schema test tables, one per operator of the inventory.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the WHOLE tables.
Lines arrive on their ship date (``updated_at`` = ship day at noon UTC) and each
ship day is one Bronze batch. Clock columns are left out; timestamps are returned
as ``timestamp_ntz`` (UTC wall clock) so every consumer sees the same values.
Faults for the quality queries are injected by fixed attribute rules, on all rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from orderlake.functions import cleaning as C
from orderlake.operators import distinct_bitmaps as db
from orderlake.operators import gold, health, quality
from orderlake.operators import gold_delta as gd
from orderlake.operators.bronze import prepare_bronze
from orderlake.operators.classify import classify_changes
from orderlake.operators.day_states import day_states
from orderlake.operators.events import to_order_events
from orderlake.operators.lines import business_day_slice, cap_per_day, invoice_day, resolve_day
from orderlake.operators.merge import changed_values, merge_latest
from orderlake.operators.staging import dropped_rows, stage_latest, type_bronze
from orderlake.plans import backfill as bf
from orderlake.plans import reports
from orderlake.session import tune_for_scale, use_utc
from orderlake.sources.retail import retail_lines
from orderlake.sources.schemas import CLOCK_COLUMNS, LANDING_COLUMNS, LANDING_SCHEMA, SILVER_COLUMNS

SOURCE_FILE = "retail_lines"
LINE_KEYS = ("invoice_no", "line_no")
CUSTOMER_KEYS = ("customer_id", "line_no")
# Load boundary of the two-batch merge queries: lines shipped before it form the
# first load, the rest the second.
MERGE_CUTOVER = "1998-06-01"
CAP_PER_DAY = 10
# First day of the backfill whose per-day states are reported; Silver holds the days before it.
BACKFILL_CUTOVER = "1996-01-01"
DQ_RUN_ID = "dq-oracle"
# The second of two overlapping extracts begins here.
OVERLAP_FROM = "1998-03-01"
# An event of at least this value is a failed run.
FAILED_FROM = 100

SILVER_OUT = [c for c in SILVER_COLUMNS if c not in CLOCK_COLUMNS]
LINE_OUT = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country", "line_no"]


def _ntz(df: DataFrame) -> DataFrame:
    cols = [
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def _prep(spark: SparkSession) -> None:
    use_utc(spark)
    tune_for_scale(spark)


# ------------------------------------------------------------------ shared derivations


_LINES: dict[tuple[int, str], DataFrame] = {}


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Source lines; the (lazy, already analysed) DataFrame is reused per session."""
    _prep(spark)
    key = (spark.sparkContext.applicationId, sf)  # the id changes with every new Spark context
    cached = _LINES.get(key)
    if cached is None or cached.sparkSession is not spark:
        cached = _LINES[key] = retail_lines(spark, sf)  # the join with orders deals a scan of one task out
    return cached


def _ship_day() -> F.Column:
    return F.to_date(F.col("arrival_ts").cast("timestamp"))


def events(spark: SparkSession, sf: str, source: DataFrame | None = None) -> DataFrame:
    src = source if source is not None else lines(spark, sf)
    return to_order_events(src, arrival_date=_ship_day(), keep=["line_no"])


def bronze(spark: SparkSession, sf: str, source: DataFrame | None = None) -> DataFrame:
    ev = events(spark, sf, source)
    batch = F.concat(F.lit("ship-"), F.substring("updated_at", 1, 10))
    # A line is ingested when it arrives: the ingest clock is the arrival time.
    return prepare_bronze(ev, batch_id=batch, source_file=SOURCE_FILE, ingested_at=F.try_to_timestamp("updated_at"))


def faulty_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Deterministic faults on all rows, keyed by attributes (not by ids)."""
    src = lines(spark, sf)
    return src.withColumns(
        {
            "Country": F.when(
                (F.col("order_priority") == "1-URGENT") & (F.col("market_segment") == "MACHINERY"), F.lit("  ")
            ).otherwise(F.col("Country")),
            "Quantity": F.when((F.col("discount") == 0.0) & (F.col("tax") == 0.0), F.lit(0.0)).otherwise(F.col("Quantity")),
            "UnitPrice": F.when(F.col("part_size") == 1, -F.col("UnitPrice")).otherwise(F.col("UnitPrice")),
            "InvoiceNo": F.when(
                (F.col("order_priority") == "5-LOW") & (F.col("part_size") == 50), F.lit(None).cast("string")
            ).otherwise(F.col("InvoiceNo")),
        }
    )


def broken_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Arrivals some of which staging must drop: by attributes of their part and order, on all rows."""
    ev = to_order_events(lines(spark, sf), arrival_date=_ship_day(), keep=["line_no", "part_size", "order_priority"])
    b = prepare_bronze(ev, batch_id=F.concat(F.lit("ship-"), F.substring("updated_at", 1, 10)), source_file=SOURCE_FILE, ingested_at=F.try_to_timestamp("updated_at"))
    size, urgent = F.col("part_size"), F.col("order_priority")
    return b.withColumns(
        {
            "updated_at": F.when(size == 7, F.lit("not a time")).when(size == 8, F.lit(None).cast("string")).otherwise(F.col("updated_at")),
            "order_id": F.when((size == 9) & (urgent == "1-URGENT"), F.lit(None).cast("string")).when((size == 9) & (urgent == "2-HIGH"), F.lit(" ")).otherwise(F.col("order_id")),
        }
    ).drop("part_size", "order_priority")


def silver_latest(spark: SparkSession, sf: str) -> DataFrame:
    return stage_latest(bronze(spark, sf), with_clock=False)


def silver_by_line(spark: SparkSession, sf: str, source: DataFrame | None = None) -> DataFrame:
    return stage_latest(bronze(spark, sf, source), keys=LINE_KEYS, with_clock=False)


def faulty_silver(spark: SparkSession, sf: str) -> DataFrame:
    return quality.add_duplicate_flag(silver_by_line(spark, sf, faulty_lines(spark, sf)))


def _split_loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    b = bronze(spark, sf)
    cut = F.lit(MERGE_CUTOVER).cast("date")
    day = F.substring("updated_at", 1, 10).cast("date")
    first = stage_latest(b.filter(day < cut), keys=LINE_KEYS, with_clock=False)
    second = stage_latest(b.filter(day >= cut), keys=LINE_KEYS, with_clock=False)
    return first, second


def merged_loads(spark: SparkSession, sf: str) -> DataFrame:
    first, second = _split_loads(spark, sf)
    cols = [*[c for c in SILVER_OUT], "line_no"]
    return merge_latest(first.select(*cols), second.select(*cols), keys=LINE_KEYS, columns=cols, track=["event_date"])


def undated_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines without an invoice time where a medium-priority order holds a part of size 1 (by attribute, on all rows)."""
    src = lines(spark, sf)
    unknown = (F.col("order_priority") == "3-MEDIUM") & (F.col("part_size") == 1)
    return src.withColumn("InvoiceDate", F.when(~unknown, F.col("InvoiceDate")))


def customer_loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The latest line of each customer and line number, before and from the cutover.

    Real second arrivals: a later order of the customer takes the place of the earlier one, with
    another date, product, quantity and status; some dates are NULL.
    """
    b = bronze(spark, sf, undated_lines(spark, sf))
    day, cut = F.substring("updated_at", 1, 10).cast("date"), F.lit(MERGE_CUTOVER).cast("date")
    return tuple(stage_latest(b.filter(part), keys=CUSTOMER_KEYS, with_clock=False) for part in (day < cut, day >= cut))


def maintained_gold(spark: SparkSession, sf: str, table: gd.GoldTable) -> DataFrame:
    """A business table after two loads, from the state of the first and the signed changes of the second."""
    first, second = customer_loads(spark, sf)
    cols = [*SILVER_OUT, "line_no"]
    merged = merge_latest(first.select(*cols), second.select(*cols), keys=CUSTOMER_KEYS, columns=cols, track=gd.IMAGE)
    inserts = gd.as_inserts(first)
    state = gd.next_state(table, inserts)
    references = gd.fold_references(table, gd.reference_deltas(table, inserts))
    return gd.published(table, gd.next_state(table, gd.signed_images(merged), state, references))


def overlapping_loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two extracts that overlap: lines shipped before the cutover, and lines shipped from ``OVERLAP_FROM`` on.

    A line in both has the same ``updated_at`` in both; the file name tells which load a Silver row is from.
    """
    ev = events(spark, sf)
    day = F.substring("updated_at", 1, 10).cast("date")
    parts = (day < F.lit(MERGE_CUTOVER).cast("date"), day >= F.lit(OVERLAP_FROM).cast("date"))
    out = []
    for k, part in enumerate(parts, 1):
        rows = prepare_bronze(ev.filter(part), batch_id=f"extract-{k}", source_file=f"extract-{k}.jsonl", ingested_at=F.try_to_timestamp("updated_at"))
        out.append(stage_latest(rows, keys=LINE_KEYS, with_clock=False))
    return tuple(out)


def gold_silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver_latest(spark, sf)


def ops_records(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Run log: the given events (type as step, time, value, props as message). DQ results: the checks of
    each ship day's batch of faulty lines, at its arrival."""
    _prep(spark)
    ev = spark.read.parquet(f"{sf}/events.parquet")
    log = ev.select(
        F.format_string("event-%012d", "event_id").alias("run_id"),
        F.col("event_type").alias("pipeline_step"),
        F.when(F.col("value") >= FAILED_FROM, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        F.col("value").cast("bigint").alias("row_count"),
        F.col("props").alias("message"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )
    return log, bf.batch_quality_results(type_bronze(bronze(spark, sf, faulty_lines(spark, sf))))


def backfill_range_frames(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, F.Column]:
    src = lines(spark, sf)
    # the first and last day of orders that have lines, from two columns of two tables
    with_lines = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_orderkey").alias("o_orderkey"))
    days_of = spark.read.parquet(f"{sf}/orders.parquet").join(with_lines, "o_orderkey", "left_semi").select(F.to_date("o_orderdate").alias("d"))
    start, end = days_of.agg(F.min("d")).scalar(), days_of.agg(F.max("d")).scalar()
    days = bf.day_sequence(spark, start, end)
    prefix = F.format_string(bf.RANGE_PREFIX, F.date_format(start, "yyyy-MM-dd"), F.date_format(end, "yyyy-MM-dd"))
    by_day = bf.backfill_lines(src, days)
    b = bf.backfill_bronze(by_day, prefix)
    return b, days, prefix


def backfill_over_silver(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Days, Bronze and prior Silver of a backfill of faulty lines; a customer's later lines replace the earlier ones."""
    src = faulty_lines(spark, sf)
    cut = F.lit(BACKFILL_CUTOVER).cast("date")
    earlier = to_order_events(src.filter(invoice_day(src) < cut), arrival_date=F.to_date("InvoiceDate"), keep=["line_no"])
    prior = stage_latest(prepare_bronze(earlier, batch_id="earlier", source_file=SOURCE_FILE), keys=CUSTOMER_KEYS, with_clock=False)
    days = bf.day_sequence(spark, cut, src.agg(F.max(invoice_day(src))).scalar())
    by_day = bf.backfill_lines(src.filter(invoice_day(src) >= cut), days)
    return days, bf.backfill_bronze(by_day, "states", keep=["line_no"]), prior


# ------------------------------------------------------------------ queries


def q_source_lines(spark, sf):
    return _ntz(lines(spark, sf).select(*LINE_OUT))


def q_landing_events(spark, sf):
    return events(spark, sf).select(*LANDING_COLUMNS, "line_no")


def q_line_key(spark, sf):
    ev = events(spark, sf)
    return (
        ev.groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("line_count"), F.count_distinct("line_no").alias("distinct_lines"))
    )


def q_clean_strings(spark, sf):
    """P1-P3 on lines with real NULL invoice numbers, blank countries, zero and negative values."""
    src = faulty_lines(spark, sf)
    t = {f.name: f.dataType for f in src.schema.fields}
    return src.select(
        *[C.clean_string(c, t[c]).alias(c) for c in ("InvoiceNo", "StockCode", "Description", "CustomerID", "Country")],
        C.parse_int("Quantity", t["Quantity"]).alias("Quantity"),
        C.parse_decimal("UnitPrice", t["UnitPrice"]).alias("UnitPrice"),
        "line_no",
    )


def q_half_even_price(spark, sf):
    _prep(spark)
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        C.parse_decimal(F.try_divide("l_extendedprice", "l_quantity"), li.schema["l_extendedprice"].dataType).alias("unit_price"),
        C.parse_decimal(F.col("l_extendedprice") / F.lit(2.0), li.schema["l_extendedprice"].dataType).alias("half_price"),
    )


def q_bronze_enrich(spark, sf):
    b = bronze(spark, sf)
    return b.select(*LANDING_COLUMNS, "source_file", "batch_id", "event_date", "line_no")


def q_bronze_payload_roundtrip(spark, sf):
    b = bronze(spark, sf)
    parsed = b.select(F.from_json("raw_payload", LANDING_SCHEMA).alias("p"), "line_no")
    return parsed.select(*[F.col(f"p.{c}").alias(c) for c in LANDING_COLUMNS], "line_no")


def q_business_day_slice(spark, sf):
    src = lines(spark, sf)
    latest = src.agg(F.max(invoice_day(src))).scalar()
    return _ntz(business_day_slice(src, latest).select(*LINE_OUT))


def q_day_fallback(spark, sf):
    src = lines(spark, sf)
    after_last = F.date_add(src.agg(F.max(invoice_day(src))).scalar(), 1)
    day = resolve_day(src, after_last, fallback=True)
    return _ntz(business_day_slice(src, day).select(*LINE_OUT, day.alias("resolved_day")))


def q_per_day_cap(spark, sf):
    src = lines(spark, sf)
    capped = cap_per_day(src, CAP_PER_DAY, rank_col="day_rank")
    return capped.select(invoice_day(capped).alias("invoice_day"), "day_rank", "InvoiceNo", "StockCode", "line_no", "Quantity")


def q_silver_stage_latest(spark, sf):
    return _ntz(silver_latest(spark, sf).select(*SILVER_OUT))


def q_silver_stage_by_line(spark, sf):
    return _ntz(silver_by_line(spark, sf).select(*SILVER_OUT, "line_no"))


def q_silver_merge(spark, sf):
    m = merged_loads(spark, sf)
    return _ntz(m.select(*SILVER_OUT, "line_no", "_merge_action"))


def q_silver_merge_ties(spark, sf):
    cols = [*SILVER_OUT, "line_no"]
    first, second = overlapping_loads(spark, sf)
    m = merge_latest(first.select(*cols), second.select(*cols), keys=LINE_KEYS, columns=cols, track=["event_date"])
    return _ntz(m.select(*cols, "_merge_action"))


def q_dq_duplicate_flag(spark, sf):
    s = quality.add_duplicate_flag(silver_by_line(spark, sf))
    return s.select("order_id", "invoice_no", "line_no", "stock_code", quality.DUPLICATE_FLAG)


def _dq_results(spark, sf):
    # counts without the row-level flag: one scan + one key aggregate
    s = silver_by_line(spark, sf, faulty_lines(spark, sf))
    return quality.quality_results(s, run_id=DQ_RUN_ID, duplicate_keys=["order_id"])


def q_staging_quarantine(spark, sf):
    """F1 + F2: the arrivals that staging drops, and why."""
    return dropped_rows(broken_bronze(spark, sf)).select("reason", "batch_id", "order_id", "invoice_no", "line_no", "stock_code", "updated_at")


def q_silver_stage_broken(spark, sf):
    """Staging where keys and times are missing."""
    return _ntz(stage_latest(broken_bronze(spark, sf), with_clock=False).select(*SILVER_OUT))


def q_dq_unstaged(spark, sf):
    """The checks over arrivals that were not staged: all seven find failures."""
    return quality.quality_results(type_bronze(broken_bronze(spark, sf)), run_id=DQ_RUN_ID, duplicate_keys=["order_id"]).drop("created_at")


def q_dq_results(spark, sf):
    return _dq_results(spark, sf).drop("created_at")


def q_dq_rejected(spark, sf):
    rej = quality.rejected_records(faulty_silver(spark, sf), run_id=DQ_RUN_ID, with_clock=False)
    return _ntz(rej.select(*SILVER_OUT, "line_no", quality.DUPLICATE_FLAG, "run_id", "check_name", "severity"))


def q_dq_gate_summary(spark, sf):
    return quality.critical_failures(_dq_results(spark, sf)).select("check_name", "failed_count", "total_count")


def q_dq_freshness(spark, sf):
    return _ntz(quality.freshness_check(silver_latest(spark, sf), "updated_at", hours=24))


def q_gold_daily_sales(spark, sf):
    return gold.daily_sales(gold_silver(spark, sf), with_clock=False)


def q_gold_product_performance(spark, sf):
    return gold.product_performance(gold_silver(spark, sf), with_clock=False)


def q_gold_country_revenue(spark, sf):
    return gold.country_revenue(gold_silver(spark, sf), with_clock=False)


def q_gold_order_status_summary(spark, sf):
    return gold.order_status_summary(gold_silver(spark, sf), with_clock=False)


def _health(spark, sf):
    log, dq = ops_records(spark, sf)
    return health.pipeline_health(log, dq)


def q_gold_run_health(spark, sf):
    return _ntz(_health(spark, sf))


def q_run_log_latest(spark, sf):
    """Latest run of each step: of the given events and of every ship day's batch."""
    log, _ = ops_records(spark, sf)
    batches = bf.batch_runs(type_bronze(bronze(spark, sf, faulty_lines(spark, sf))))
    return _ntz(health.latest_runs(log.unionByName(batches)))


def q_gold_affected_dates(spark, sf):
    m = merged_loads(spark, sf)
    affected = changed_values(m, "event_date")
    return gold.daily_sales_for_dates(m.drop("_merge_action", "_old_event_date"), affected, with_clock=False)


def _q_maintained(table: gd.GoldTable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: maintained_gold(spark, sf, table)


def q_report_kpis(spark, sf):
    return reports.kpis(gold.daily_sales(gold_silver(spark, sf), with_clock=False))


def q_report_daily_trend(spark, sf):
    return reports.daily_trend(gold.daily_sales(gold_silver(spark, sf), with_clock=False))


def q_report_country(spark, sf):
    return reports.country(gold.country_revenue(gold_silver(spark, sf), with_clock=False))


def q_report_top_products(spark, sf):
    return reports.top_products(gold.product_performance(gold_silver(spark, sf), with_clock=False))


def q_report_order_status(spark, sf):
    return reports.order_status(gold.order_status_summary(gold_silver(spark, sf), with_clock=False))


def q_report_health(spark, sf):
    return _ntz(reports.health(_health(spark, sf)))


def q_cancellation_rate(spark, sf):
    return gold.cancellation_rate(gold.order_status_summary(gold_silver(spark, sf), with_clock=False))


def q_change_classes(spark, sf):
    c = classify_changes(bronze(spark, sf), keys=LINE_KEYS, batch_col="batch_id")
    return _ntz(c)


def q_backfill_range(spark, sf):
    b, days, prefix = backfill_range_frames(spark, sf)
    return bf.backfill_summary(b, days, prefix)


def q_backfill_silver(spark, sf):
    b, _, _ = backfill_range_frames(spark, sf)
    return _ntz(bf.backfill_silver(b, with_clock=False).select(*SILVER_OUT))


def _from_bitmaps(rows: DataFrame, fine: list[str], coarse: list[F.Column]) -> DataFrame:
    """Distinct customers and invoices of coarse groups, from the state of fine ones."""
    parts = []
    for column, name in (("customer_id", "customer_count"), ("invoice_no", "invoice_count")):
        state = db.bitmaps(rows, fine, column, db.dictionary(rows, column))
        parts.append(db.counts(db.rolled_up(state, coarse), name))
    groups = [c for c in parts[0].columns if c != "customer_count"]
    both = parts[0].unionByName(parts[1], allowMissingColumns=True)
    return both.groupBy(*groups).agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in ("customer_count", "invoice_count")])


def q_distinct_by_month(spark, sf):
    """Months (a NULL one too) from the state of days."""
    first, second = customer_loads(spark, sf)
    rows = first.unionByName(second).select("event_date", "customer_id", "invoice_no")
    return _from_bitmaps(rows, ["event_date"], [F.trunc("event_date", "month").alias("month")])


def q_distinct_by_country(spark, sf):
    """Countries over all time from the state of (country, month)."""
    rows = gold_silver(spark, sf).select("country", F.trunc("event_date", "month").alias("month"), "customer_id", "invoice_no")
    return _from_bitmaps(rows, ["country", "month"], [F.col("country")])


def q_backfill_states(spark, sf):
    days, rows, prior = backfill_over_silver(spark, sf)
    return day_states(days, rows, prior, keys=CUSTOMER_KEYS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "source_lines": q_source_lines,
    "landing_events": q_landing_events,
    "line_key": q_line_key,
    "clean_strings": q_clean_strings,
    "half_even_price": q_half_even_price,
    "bronze_enrich": q_bronze_enrich,
    "bronze_payload_roundtrip": q_bronze_payload_roundtrip,
    "business_day_slice": q_business_day_slice,
    "day_fallback": q_day_fallback,
    "per_day_cap": q_per_day_cap,
    "silver_stage_latest": q_silver_stage_latest,
    "silver_stage_by_line": q_silver_stage_by_line,
    "silver_merge": q_silver_merge,
    "silver_merge_ties": q_silver_merge_ties,
    "dq_duplicate_flag": q_dq_duplicate_flag,
    "staging_quarantine": q_staging_quarantine,
    "silver_stage_broken": q_silver_stage_broken,
    "dq_unstaged": q_dq_unstaged,
    "dq_results": q_dq_results,
    "dq_rejected": q_dq_rejected,
    "dq_gate_summary": q_dq_gate_summary,
    "dq_freshness": q_dq_freshness,
    "gold_daily_sales": q_gold_daily_sales,
    "gold_product_performance": q_gold_product_performance,
    "gold_country_revenue": q_gold_country_revenue,
    "gold_order_status_summary": q_gold_order_status_summary,
    "gold_run_health": q_gold_run_health,
    "gold_affected_dates": q_gold_affected_dates,
    **{f"gold_maintained_{table.name}": _q_maintained(table) for table in gd.GOLD_TABLES},
    "distinct_by_month": q_distinct_by_month,
    "distinct_by_country": q_distinct_by_country,
    "report_kpis": q_report_kpis,
    "report_daily_trend": q_report_daily_trend,
    "report_country": q_report_country,
    "report_top_products": q_report_top_products,
    "report_order_status": q_report_order_status,
    "report_health": q_report_health,
    "cancellation_rate": q_cancellation_rate,
    "change_classes": q_change_classes,
    "backfill_range": q_backfill_range,
    "backfill_silver": q_backfill_silver,
    "backfill_states": q_backfill_states,
    "run_log_latest": q_run_log_latest,
}
