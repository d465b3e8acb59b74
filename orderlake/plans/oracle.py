"""Reference SQL (DuckDB dialect) for every registered query, written independently of Spark.

Tables ``lineitem orders part customer nation`` are views over the same parquet
files. Money keeps Spark's decimal result types (explicit casts), counts are
BIGINT, positions are INTEGER. Nothing is taken from the library: predicates, cutovers and
caps are written out here.
"""

from __future__ import annotations

# Name, severity, description and predicate text of the checks, and the predicate in words of this file.
CHECKS = [
    ("silver_order_id_not_null", "critical", "Every Silver order row must have a natural key.",
     "order_id IS NULL OR trim(order_id) = ''", "length(trim(coalesce(order_id, ''))) = 0"),
    ("silver_no_duplicate_order_ids", "critical", "Silver must contain at most one current row per order_id.",
     "__duplicate_order_id = true", "__duplicate_order_id"),
    ("silver_updated_at_not_null", "critical", "Every Silver row must have an updated_at timestamp for merge ordering.",
     "updated_at IS NULL", "updated_at IS NOT DISTINCT FROM NULL"),
    ("silver_quantity_not_zero", "critical", "UCI rows can be positive sales or negative cancellations, but quantity should not be zero.",
     "quantity = 0 OR quantity IS NULL", "coalesce(quantity, 0) = 0"),
    ("silver_unit_price_non_negative", "critical", "Unit price should not be negative.",
     "unit_price < 0 OR unit_price IS NULL", "NOT coalesce(unit_price >= 0, false)"),
    ("silver_invoice_no_present", "warning", "Invoice number should be present for lineage back to the public dataset.",
     "invoice_no IS NULL OR trim(invoice_no) = ''", "length(trim(coalesce(invoice_no, ''))) = 0"),
    ("silver_country_present", "warning", "Country should be populated for country-level Gold aggregations.",
     "country IS NULL OR trim(country) = ''", "length(trim(coalesce(country, ''))) = 0"),
]
# Parameters of the queries, as this file knows them.
CAP_PER_DAY = 10
DQ_RUN_ID = "dq-oracle"
MERGE_CUTOVER = "1998-06-01"
BACKFILL_CUTOVER = "1996-01-01"

TRIM_RE = r"'^\s+|\s+$'"

LINES = """
lines AS (
  SELECT
    CASE WHEN l.l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(l.l_orderkey AS VARCHAR) AS InvoiceNo,
    CAST(l.l_partkey AS VARCHAR) AS StockCode,
    p.p_name AS Description,
    CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS Quantity,
    o.o_orderdate AS InvoiceDate,
    p.p_retailprice AS UnitPrice,
    CAST(o.o_custkey AS VARCHAR) AS CustomerID,
    n.n_name AS Country,
    l.l_shipdate AS arrival_ts,
    l.l_linenumber AS line_no,
    o.o_orderpriority AS order_priority,
    o.o_orderstatus AS order_status_code,
    c.c_mktsegment AS market_segment,
    p.p_size AS part_size,
    l.l_linestatus AS line_status,
    l.l_discount AS discount,
    l.l_tax AS tax
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

FAULTY = """
faulty AS (
  SELECT * REPLACE (
    CASE WHEN order_priority = '1-URGENT' AND market_segment = 'MACHINERY' THEN '  ' ELSE Country END AS Country,
    CASE WHEN discount = 0.0 AND tax = 0.0 THEN 0.0 ELSE Quantity END AS Quantity,
    CASE WHEN part_size = 1 THEN -UnitPrice ELSE UnitPrice END AS UnitPrice,
    CASE WHEN order_priority = '5-LOW' AND part_size = 50 THEN NULL ELSE InvoiceNo END AS InvoiceNo
  )
  FROM lines
)"""

LANDING = [
    "order_id", "invoice_no", "stock_code", "customer_id", "product_id", "product_name", "order_status",
    "quantity", "unit_price", "currency", "channel", "country", "is_cancellation", "event_time",
    "updated_at", "source_system",
]
SILVER_OUT = [
    "order_id", "invoice_no", "stock_code", "customer_id", "product_id", "product_name", "order_status",
    "quantity", "unit_price", "currency", "channel", "country", "is_cancellation", "event_time",
    "updated_at", "source_system", "source_file", "bronze_batch_id", "event_date", "order_amount",
]
LINE_OUT = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country, line_no"
ORDER_TIEBREAK = (
    "source_system DESC NULLS LAST, quantity DESC NULLS LAST, unit_price DESC NULLS LAST, "
    "stock_code ASC NULLS LAST, product_name ASC NULLS LAST, customer_id ASC NULLS LAST, "
    "country ASC NULLS LAST, event_time ASC NULLS LAST, invoice_no ASC NULLS LAST, order_id ASC NULLS LAST"
)


def _clean(expr: str) -> str:
    return f"coalesce(regexp_replace({expr}, {TRIM_RE}, '', 'g'), '')"


def _price(expr: str) -> str:
    return (
        f"coalesce(CAST(round_even(TRY_CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DECIMAL(38,2)), "
        "CAST(0 AS DECIMAL(38,2)))"
    )


def events(src: str, name: str, arrival: str = "CAST(arrival_ts AS DATE)", carry: str = "") -> str:
    extra = f", {carry}" if carry else ""
    return f"""
{name}_clean AS (
  SELECT
    {_clean('InvoiceNo')} AS inv,
    {_clean('StockCode')} AS stock,
    {_clean('Description')} AS descr,
    {_clean('CustomerID')} AS cust,
    {_clean('Country')} AS ctry,
    coalesce(TRY_CAST(trunc(Quantity) AS BIGINT), 0) AS qty,
    {_price('UnitPrice')} AS price,
    CAST(InvoiceDate AS TIMESTAMP) AS inv_ts,
    {arrival} AS arrival_day,
    line_no{extra}
  FROM {src}
),
{name} AS (
  SELECT
    concat_ws('|', inv, stock, strftime(inv_ts, '%Y%m%d%H%M%S')) AS order_id,
    inv AS invoice_no,
    stock AS stock_code,
    cust AS customer_id,
    stock AS product_id,
    descr AS product_name,
    CASE WHEN starts_with(upper(inv), 'C') THEN 'cancelled' ELSE 'completed' END AS order_status,
    qty AS quantity,
    CAST(price AS VARCHAR) AS unit_price,
    'GBP' AS currency,
    'online_retail' AS channel,
    ctry AS country,
    starts_with(upper(inv), 'C') AS is_cancellation,
    strftime(inv_ts, '%Y-%m-%dT%H:%M:%SZ') AS event_time,
    strftime(arrival_day, '%Y-%m-%d') || 'T12:00:00Z' AS updated_at,
    'uci_online_retail' AS source_system,
    line_no{extra}
  FROM {name}_clean
)"""


def bronze(ev: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT e.*, 'retail_lines' AS source_file, 'ship-' || substr(updated_at, 1, 10) AS batch_id,
         CAST(substr(event_time, 1, 10) AS DATE) AS event_date
  FROM {ev} e
)"""


def typed(src: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT * REPLACE (
      TRY_CAST(event_time AS TIMESTAMP) AS event_time,
      TRY_CAST(updated_at AS TIMESTAMP) AS updated_at,
      TRY_CAST(quantity AS INTEGER) AS quantity,
      TRY_CAST(unit_price AS DECIMAL(12,2)) AS unit_price
    ),
    CAST(TRY_CAST(quantity AS INTEGER) * TRY_CAST(unit_price AS DECIMAL(12,2)) AS DECIMAL(23,2)) AS order_amount,
    batch_id AS bronze_batch_id
  FROM {src}
)"""


def stage(src: str, name: str, keys: str, then_by: str = "") -> str:
    """Latest row per key from typed rows."""
    not_null = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    mid = f"{then_by}, " if then_by else ""
    return f"""
{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY {keys}
      ORDER BY updated_at DESC NULLS LAST, {mid}{ORDER_TIEBREAK}) AS rn
    FROM {src}
    WHERE {not_null} AND updated_at IS NOT NULL
  ) WHERE rn = 1
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


SHIP = (LINES, events("lines", "ev"), bronze("ev", "br"), typed("br", "ty"))
SILVER = (*SHIP, stage("ty", "silver", "order_id"))
BY_LINE = (*SHIP, stage("ty", "silver_line", "invoice_no, line_no"))
FAULTY_SILVER = (
    LINES,
    FAULTY,
    events("faulty", "fev"),
    bronze("fev", "fbr"),
    typed("fbr", "fty"),
    stage("fty", "fsl", "invoice_no, line_no"),
    """
fs AS (SELECT *, count(*) OVER (PARTITION BY order_id) > 1 AS __duplicate_order_id FROM fsl)""",
)

SILVER_COLS = ", ".join(SILVER_OUT)


def _q(s: str) -> str:
    return s.replace("'", "''")


def results_from(agg_src: str, run_id: str, extra_cols: str = "") -> str:
    """UNION ALL of one row per check over an aggregate holding f0..f6 and total."""
    parts = []
    for i, (name, severity, description, text, _) in enumerate(CHECKS):
        parts.append(
            f"SELECT {run_id} AS run_id, '{name}' AS check_name, 'silver.orders' AS table_name, "
            f"'{severity}' AS severity, CASE WHEN f{i} > 0 THEN 'fail' ELSE 'pass' END AS status, "
            f"CAST(f{i} AS BIGINT) AS failed_count, CAST(total AS BIGINT) AS total_count, "
            f"CASE WHEN total > 0 THEN CAST(f{i} AS DOUBLE) / CAST(total AS DOUBLE) ELSE 0.0::DOUBLE END AS failure_rate, "
            f"'{_q(description)}' AS description, '{_q(text)}' AS failure_expression{extra_cols} "
            f"FROM {agg_src}"
        )
    return "\nUNION ALL\n".join(parts)


def _count_ifs() -> str:
    return ", ".join(f"count_if({predicate}) AS f{i}" for i, (*_, predicate) in enumerate(CHECKS))


DQ_RESULTS = _with(
    *FAULTY_SILVER,
    f"""
agg AS (SELECT {_count_ifs()}, count(*) AS total FROM fs)""",
) + "\n" + results_from("agg", f"'{DQ_RUN_ID}'")

DQ_REJECTED = _with(*FAULTY_SILVER) + "\n" + "\nUNION ALL\n".join(
    f"SELECT {SILVER_COLS}, line_no, __duplicate_order_id, '{DQ_RUN_ID}' AS run_id, '{name}' AS check_name, "
    f"'{severity}' AS severity FROM fs WHERE {predicate}"
    for name, severity, _, _, predicate in CHECKS
)

DQ_GATE = _with(
    *FAULTY_SILVER,
    f"""
agg AS (SELECT {_count_ifs()}, count(*) AS total FROM fs)""",
    f"""
res AS ({results_from('agg', f"'{DQ_RUN_ID}'")})""",
) + "\nSELECT check_name, failed_count, total_count FROM res WHERE severity = 'critical' AND status = 'fail'"

OPS = (
    LINES,
    FAULTY,
    events("faulty", "fev"),
    bronze("fev", "fbr"),
    typed("fbr", "fty"),
    """
flag AS (SELECT *, count(*) OVER (PARTITION BY bronze_batch_id, order_id) > 1 AS __duplicate_order_id FROM fty)""",
    f"""
dqagg AS (
  SELECT bronze_batch_id AS run_id, {_count_ifs()}, count(*) AS total, min(updated_at) AS created_at
  FROM flag GROUP BY bronze_batch_id
)""",
    f"""
dq AS ({results_from('dqagg', 'run_id', ', created_at')})""",
    """
latest AS (
  SELECT event_type AS pipeline_step, ts AS last_run_at, CASE WHEN value >= 100 THEN 'failed' ELSE 'success' END AS last_status, props AS last_message
  FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1
)""",
    """
health AS (
  SELECT pipeline_step, last_run_at, last_status, last_message FROM latest
  UNION ALL
  SELECT 'data_quality_summary', max(created_at),
         CASE WHEN sum(CASE WHEN status = 'fail' THEN 1 ELSE 0 END) > 0 THEN 'failed' ELSE 'success' END,
         'DQ failures: ' || CAST(sum(CASE WHEN status = 'fail' THEN 1 ELSE 0 END) AS VARCHAR)
  FROM dq GROUP BY table_name
)""",
)

BATCH_RUNS = """
batch_runs AS (
  SELECT bronze_batch_id AS run_id, 'bronze_orders' AS pipeline_step, 'success' AS status, count(*) AS row_count,
         'Ingested Bronze orders for ' || bronze_batch_id AS message, min(updated_at) AS created_at
  FROM fty GROUP BY bronze_batch_id
  UNION ALL
  SELECT bronze_batch_id, 'silver_orders', 'success', count(DISTINCT order_id),
         'Merged staged Bronze orders for ' || bronze_batch_id, min(updated_at)
  FROM fty GROUP BY bronze_batch_id
  UNION ALL
  SELECT run_id, 'quality_checks',
         CASE WHEN max(CASE WHEN severity = 'critical' AND status = 'fail' THEN 1 ELSE 0 END) = 1 THEN 'failed' ELSE 'success' END,
         count(*), 'Completed ' || CAST(count(*) AS VARCHAR) || ' Silver data quality checks', max(created_at)
  FROM dq GROUP BY run_id
)"""

GOLD_DAILY = """
SELECT event_date,
       count(DISTINCT invoice_no) AS invoice_count,
       count(DISTINCT customer_id) AS customer_count,
       count(*) AS line_count,
       CAST(sum(quantity) AS BIGINT) AS net_units,
       CAST(sum(order_amount) AS DECIMAL(33,2)) AS net_revenue,
       CAST(sum(CASE WHEN is_cancellation THEN 1 ELSE 0 END) AS BIGINT) AS cancellation_lines
FROM {src} GROUP BY event_date"""

GOLD_PRODUCT = """
SELECT product_id, product_name, count(*) AS line_count, count(DISTINCT invoice_no) AS invoice_count,
       CAST(sum(quantity) AS BIGINT) AS net_units, CAST(sum(order_amount) AS DECIMAL(33,2)) AS net_revenue
FROM {src} GROUP BY product_id, product_name"""

GOLD_COUNTRY = """
SELECT country, count(*) AS line_count, count(DISTINCT invoice_no) AS invoice_count,
       count(DISTINCT customer_id) AS customer_count, CAST(sum(order_amount) AS DECIMAL(33,2)) AS net_revenue
FROM {src} GROUP BY country"""

GOLD_STATUS = """
SELECT order_status, is_cancellation, count(*) AS line_count, count(DISTINCT invoice_no) AS invoice_count,
       CAST(sum(quantity) AS BIGINT) AS net_units, CAST(sum(order_amount) AS DECIMAL(33,2)) AS net_revenue
FROM {src} GROUP BY order_status, is_cancellation"""


def _merge(target: str, source: str, cols: list[str], keys: list[str]) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    take = "(t.__tp IS NULL OR (s.__sp IS NOT NULL AND coalesce(s.updated_at > t.updated_at, false)))"
    picks = ",\n    ".join(f"CASE WHEN {take} THEN s.{c} ELSE t.{c} END AS {c}" for c in cols)
    action = (
        "CASE WHEN t.__tp IS NULL THEN 'insert' WHEN s.__sp IS NULL THEN 'target_only' "
        "WHEN coalesce(s.updated_at > t.updated_at, false) THEN 'update' ELSE 'keep' END AS _merge_action"
    )
    return f"""
merged AS (
  SELECT
    {picks},
    {action},
    t.event_date AS _old_event_date
  FROM (SELECT *, true AS __tp FROM {target}) t
  FULL OUTER JOIN (SELECT *, true AS __sp FROM {source}) s ON {on}
)"""


MERGE_COLS = [*SILVER_OUT, "line_no"]
TWO_LOADS = (
    *SHIP,
    stage(f"(SELECT * FROM ty WHERE CAST(substr(batch_id, 6, 10) AS DATE) < DATE '{MERGE_CUTOVER}')", "load1", "invoice_no, line_no"),
    stage(f"(SELECT * FROM ty WHERE CAST(substr(batch_id, 6, 10) AS DATE) >= DATE '{MERGE_CUTOVER}')", "load2", "invoice_no, line_no"),
    _merge("load1", "load2", MERGE_COLS, ["invoice_no", "line_no"]),
)

TIES = (
    LINES,
    events("lines", "ev"),
    """
extracts AS (
  SELECT *, 1 AS load FROM ev WHERE CAST(substr(updated_at, 1, 10) AS DATE) < DATE '1998-06-01'
  UNION ALL
  SELECT *, 2 FROM ev WHERE CAST(substr(updated_at, 1, 10) AS DATE) >= DATE '1998-03-01'
),
named AS (
  SELECT * EXCLUDE (load), 'extract-' || load || '.jsonl' AS source_file, 'extract-' || load AS batch_id, CAST(substr(event_time, 1, 10) AS DATE) AS event_date
  FROM extracts
)""",
    typed("named", "nty"),
    stage("(SELECT * FROM nty WHERE batch_id = 'extract-1')", "extract1", "invoice_no, line_no"),
    stage("(SELECT * FROM nty WHERE batch_id = 'extract-2')", "extract2", "invoice_no, line_no"),
    _merge("extract1", "extract2", MERGE_COLS, ["invoice_no", "line_no"]),
)

DETAIL = "source_system, quantity, unit_price, stock_code, product_name, customer_id, country, event_time, order_id"
DETAIL_ORDER = ", ".join(f"{c} ASC NULLS FIRST" for c in DETAIL.split(", "))
CHANGE_CLASSES = _with(
    LINES,
    events("lines", "ev"),
    bronze("ev", "br"),
    f"""
r AS (
  SELECT invoice_no, line_no, batch_id, TRY_CAST(updated_at AS TIMESTAMP) AS u, event_date, {DETAIL}
  FROM br WHERE updated_at IS NOT NULL AND invoice_no IS NOT NULL AND line_no IS NOT NULL
),
r2 AS (SELECT * FROM r WHERE u IS NOT NULL),
dr AS (SELECT invoice_no, line_no, batch_id, u, event_date, {DETAIL}, count(*) AS copies FROM r2 GROUP BY ALL),
pb AS (SELECT invoice_no, line_no, batch_id, max(u) AS bmax, min(u) AS bmin FROM r2 GROUP BY ALL),
pb2 AS (
  SELECT *,
    max(bmax) OVER (PARTITION BY invoice_no, line_no ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_max,
    min(batch_id) OVER (PARTITION BY invoice_no, line_no) AS first_batch
  FROM pb
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY invoice_no, line_no, batch_id, u ORDER BY {DETAIL_ORDER}) AS rk FROM dr
),
cls AS (
  SELECT d.*,
    CASE WHEN d.batch_id = p.first_batch AND d.u = p.bmin THEN 'new'
         WHEN p.prior_max IS NULL OR d.u > p.prior_max THEN 'correction'
         ELSE 'replay' END AS lead
  FROM ranked d JOIN pb2 p ON d.invoice_no = p.invoice_no AND d.line_no = p.line_no AND d.batch_id = p.batch_id
),
outrows AS (
  SELECT * EXCLUDE (lead, copies, rk), lead AS change_class, CAST(1 AS BIGINT) AS row_count FROM cls WHERE rk = 1
  UNION ALL
  SELECT * EXCLUDE (lead, copies, rk), 'replay', CAST(copies - 1 AS BIGINT) FROM cls WHERE rk = 1 AND copies > 1
  UNION ALL
  SELECT * EXCLUDE (lead, copies, rk), 'replay', CAST(copies AS BIGINT) FROM cls WHERE rk > 1
)""",
) + f"""
SELECT invoice_no, line_no, batch_id, u AS updated_at, event_date, {DETAIL}, change_class, row_count,
       CAST(u AS DATE) > event_date AS is_late
FROM outrows"""

LINE_ORDER = (
    "InvoiceNo ASC NULLS FIRST, line_no ASC NULLS FIRST, StockCode ASC NULLS FIRST, Quantity ASC NULLS FIRST, "
    "UnitPrice ASC NULLS FIRST, CustomerID ASC NULLS FIRST, Description ASC NULLS FIRST"
)
BACKFILL = (
    LINES,
    """
bounds AS (SELECT min(CAST(InvoiceDate AS DATE)) AS s, max(CAST(InvoiceDate AS DATE)) AS e FROM lines),
days AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS run_date FROM bounds),
prefix AS (SELECT 'backfill-' || strftime(s, '%Y-%m-%d') || '-to-' || strftime(e, '%Y-%m-%d') AS p FROM bounds),
sliced AS (
  SELECT l.*, d.run_date FROM lines l JOIN days d ON CAST(l.InvoiceDate AS DATE) = d.run_date
),
capped AS (
  SELECT * FROM sliced
)""",
    events("capped", "bev", arrival="run_date", carry="run_date"),
    """
bbr AS (
  SELECT e.*,
    'landing/orders/event_date=' || strftime(run_date, '%Y-%m-%d') || '/batch_id=' || (SELECT p FROM prefix)
      || '-landing-' || strftime(run_date, '%Y-%m-%d') || '/orders.jsonl' AS source_file,
    (SELECT p FROM prefix) || '-bronze-' || strftime(run_date, '%Y-%m-%d') AS batch_id,
    CAST(substr(event_time, 1, 10) AS DATE) AS event_date
  FROM bev e
)""",
    typed("bbr", "bty"),
)


CUSTOMER_LOADS = (
    LINES,
    """
undated AS (
  SELECT * REPLACE (CASE WHEN order_priority = '3-MEDIUM' AND part_size = 1 THEN NULL ELSE InvoiceDate END AS InvoiceDate) FROM lines
)""",
    events("undated", "uev"),
    bronze("uev", "ubr"),
    typed("ubr", "uty"),
    stage("(SELECT * FROM uty WHERE CAST(substr(batch_id, 6, 10) AS DATE) < DATE '1998-06-01')", "cload1", "customer_id, line_no"),
    stage("(SELECT * FROM uty WHERE CAST(substr(batch_id, 6, 10) AS DATE) >= DATE '1998-06-01')", "cload2", "customer_id, line_no"),
    _merge("cload1", "cload2", MERGE_COLS, ["customer_id", "line_no"]),
)


BROKEN = (
    LINES,
    events("lines", "wev", carry="part_size, order_priority"),
    bronze("wev", "wbr"),
    """
broken AS (
  SELECT * EXCLUDE (part_size, order_priority) REPLACE (
    CASE part_size WHEN 7 THEN 'not a time' WHEN 8 THEN NULL ELSE updated_at END AS updated_at,
    CASE WHEN part_size = 9 AND order_priority = '1-URGENT' THEN NULL WHEN part_size = 9 AND order_priority = '2-HIGH' THEN ' ' ELSE order_id END AS order_id
  )
  FROM wbr
)""",
    typed("broken", "wty"),
)


BILLED = """
billed AS (SELECT * REPLACE (date_trunc('month', InvoiceDate) AS InvoiceDate) FROM faulty)"""
LAKE_OF_DAYS = (
    LINES,
    FAULTY,
    events("faulty", "lev"),
    """
lbr AS (
  SELECT *, '' AS source_file, CASE WHEN substr(updated_at, 1, 10) < '1998-06-01' THEN 'lake-1' ELSE 'lake-2' END AS batch_id,
         TRY_CAST(substr(event_time, 1, 10) AS DATE) AS event_date
  FROM lev
)""",
    typed("lbr", "lty"),
    stage("(SELECT * FROM lty WHERE batch_id = 'lake-1')", "lload1", "order_id"),
    stage("(SELECT * FROM lty WHERE batch_id = 'lake-2')", "lload2", "order_id"),
    _merge("lload1", "lload2", SILVER_OUT, ["order_id"]),
    """
silver AS (SELECT * FROM merged)""",
)
LAKE = (LINES, FAULTY, BILLED, events("billed", "lev"), *LAKE_OF_DAYS[3:])


def _numbered(select: str, order: str) -> str:
    return f"SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS row_num FROM ({select})"


def oracle_sql() -> dict[str, str]:
    silver_gold = _with(*SILVER)
    q: dict[str, str] = {}
    q["source_lines"] = _with(LINES) + f"\nSELECT {LINE_OUT} FROM lines"
    q["landing_events"] = _with(LINES, events("lines", "ev")) + f"\nSELECT {', '.join(LANDING)}, line_no FROM ev"
    q["line_key"] = _with(LINES, events("lines", "ev")) + (
        "\nSELECT order_id, count(*) AS line_count, count(DISTINCT line_no) AS distinct_lines "
        "FROM ev GROUP BY order_id"
    )
    q["clean_strings"] = _with(LINES, FAULTY) + (
        f"\nSELECT {_clean('InvoiceNo')} AS InvoiceNo, {_clean('StockCode')} AS StockCode, "
        f"{_clean('Description')} AS Description, {_clean('CustomerID')} AS CustomerID, {_clean('Country')} AS Country, "
        f"coalesce(TRY_CAST(trunc(Quantity) AS BIGINT), 0) AS Quantity, {_price('UnitPrice')} AS UnitPrice, line_no FROM faulty"
    )
    unit = "CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END"
    q["half_even_price"] = (
        f"SELECT l_orderkey, l_linenumber, {_price(unit)} AS unit_price, "
        f"{_price('l_extendedprice / CAST(2 AS DOUBLE)')} AS half_price FROM lineitem"
    )
    q["bronze_enrich"] = _with(*SHIP[:3]) + f"\nSELECT {', '.join(LANDING)}, source_file, batch_id, event_date, line_no FROM br"
    q["bronze_payload_roundtrip"] = _with(LINES, events("lines", "ev")) + f"\nSELECT {', '.join(LANDING)}, line_no FROM ev"
    q["business_day_slice"] = _with(LINES) + (
        f"\nSELECT {LINE_OUT} FROM lines "
        "WHERE CAST(InvoiceDate AS DATE) = (SELECT max(CAST(InvoiceDate AS DATE)) FROM lines)"
    )
    q["day_fallback"] = _with(
        LINES,
        """
d AS (SELECT DISTINCT CAST(InvoiceDate AS DATE) AS d FROM lines),
pick AS (
  SELECT coalesce(
    (SELECT max(d) FROM d WHERE d = (SELECT max(d) + 1 FROM d)),
    (SELECT min(d) FROM d)) AS resolved_day
)""",
    ) + f"\nSELECT {LINE_OUT}, (SELECT resolved_day FROM pick) AS resolved_day FROM lines WHERE CAST(InvoiceDate AS DATE) = (SELECT resolved_day FROM pick)"
    q["per_day_cap"] = _with(LINES) + (
        "\nSELECT invoice_day, day_rank, InvoiceNo, StockCode, line_no, Quantity FROM ("
        "SELECT *, CAST(InvoiceDate AS DATE) AS invoice_day, CAST(row_number() OVER ("
        f"PARTITION BY CAST(InvoiceDate AS DATE) ORDER BY {LINE_ORDER}) AS INTEGER) AS day_rank FROM lines) "
        f"WHERE day_rank <= {CAP_PER_DAY}"
    )
    q["silver_stage_latest"] = silver_gold + f"\nSELECT {SILVER_COLS} FROM silver"
    q["silver_stage_by_line"] = _with(*BY_LINE) + f"\nSELECT {SILVER_COLS}, line_no FROM silver_line"
    q["silver_merge"] = _with(*TWO_LOADS) + f"\nSELECT {SILVER_COLS}, line_no, _merge_action FROM merged"
    q["silver_merge_ties"] = _with(*TIES) + f"\nSELECT {SILVER_COLS}, line_no, _merge_action FROM merged"
    q["dq_duplicate_flag"] = _with(*BY_LINE) + (
        "\nSELECT order_id, invoice_no, line_no, stock_code, "
        "count(*) OVER (PARTITION BY order_id) > 1 AS __duplicate_order_id FROM silver_line"
    )
    q["staging_quarantine"] = _with(*BROKEN) + """
SELECT CASE WHEN order_id IS NULL THEN 'null_key' WHEN updated_at IS NULL THEN 'no_time' ELSE 'unreadable_time' END AS reason,
       batch_id, order_id, invoice_no, line_no, stock_code, updated_at
FROM broken WHERE order_id IS NULL OR TRY_CAST(updated_at AS TIMESTAMP) IS NULL"""
    q["silver_stage_broken"] = _with(*BROKEN, stage("wty", "wsl", "order_id")) + f"\nSELECT {SILVER_COLS} FROM wsl"
    q["dq_unstaged"] = _with(
        *BROKEN,
        """
wfl AS (SELECT *, count(*) OVER (PARTITION BY order_id) > 1 AS __duplicate_order_id FROM wty)""",
        f"""
wagg AS (SELECT {_count_ifs()}, count(*) AS total FROM wfl)""",
    ) + "\n" + results_from("wagg", f"'{DQ_RUN_ID}'")
    q["dq_results"] = DQ_RESULTS
    q["dq_rejected"] = DQ_REJECTED
    q["dq_gate_summary"] = DQ_GATE
    q["dq_freshness"] = silver_gold + """
SELECT 'silver_freshness' AS check_name, 'silver.orders' AS table_name, 'warning' AS severity,
       last_event_time, as_of,
       CAST(epoch_us(as_of) - epoch_us(last_event_time) AS DOUBLE) / CAST(3600000000 AS DOUBLE) AS lag_hours,
       CASE WHEN coalesce(last_event_time < as_of - INTERVAL 24 HOUR, true) THEN 'fail' ELSE 'pass' END AS status
FROM (SELECT max(event_time) AS last_event_time, (SELECT max(updated_at) FROM silver) AS as_of FROM silver)"""
    q["gold_daily_sales"] = silver_gold + GOLD_DAILY.format(src="silver")
    q["gold_product_performance"] = silver_gold + GOLD_PRODUCT.format(src="silver")
    q["gold_country_revenue"] = silver_gold + GOLD_COUNTRY.format(src="silver")
    q["gold_order_status_summary"] = silver_gold + GOLD_STATUS.format(src="silver")
    q["gold_run_health"] = _with(*OPS) + "\nSELECT pipeline_step, last_run_at, last_status, last_message FROM health"
    q["run_log_latest"] = _with(*OPS, BATCH_RUNS) + """
SELECT pipeline_step, last_run_at, last_status, last_message FROM latest
UNION ALL
SELECT pipeline_step, created_at, status, message FROM batch_runs
QUALIFY row_number() OVER (PARTITION BY pipeline_step ORDER BY created_at DESC, run_id DESC) = 1"""
    q["gold_affected_dates"] = _with(
        *TWO_LOADS,
        """
affected AS (
  SELECT event_date FROM merged WHERE _merge_action IN ('insert', 'update')
  UNION
  SELECT _old_event_date FROM merged WHERE _merge_action IN ('insert', 'update') AND _old_event_date IS NOT NULL
),
scoped AS (SELECT * FROM merged WHERE event_date IN (SELECT event_date FROM affected))""",
    ) + GOLD_DAILY.format(src="scoped")
    rebuilt = {"daily_sales": GOLD_DAILY, "product_performance": GOLD_PRODUCT, "country_revenue": GOLD_COUNTRY, "order_status_summary": GOLD_STATUS}
    for name, select in rebuilt.items():
        q[f"gold_maintained_{name}"] = _with(*CUSTOMER_LOADS) + select.format(src="merged")
    q["distinct_by_month"] = _with(*CUSTOMER_LOADS) + """
SELECT CAST(date_trunc('month', event_date) AS DATE) AS month, count(DISTINCT customer_id) AS customer_count, count(DISTINCT invoice_no) AS invoice_count
FROM (SELECT * FROM cload1 UNION ALL SELECT * FROM cload2) GROUP BY 1"""
    q["distinct_by_country"] = silver_gold + """
SELECT country, count(DISTINCT customer_id) AS customer_count, count(DISTINCT invoice_no) AS invoice_count FROM silver GROUP BY country"""
    daily = f"({GOLD_DAILY.format(src='silver')})"
    q["report_kpis"] = silver_gold + f"""
SELECT CAST(sum(net_revenue) AS DOUBLE) AS net_revenue, CAST(sum(net_units) AS BIGINT) AS net_units,
       CAST(sum(invoice_count) AS BIGINT) AS invoice_count, max(customer_count) AS customer_count,
       CAST(sum(line_count) AS BIGINT) AS line_count
FROM {daily}"""
    q["report_daily_trend"] = silver_gold + "\n" + _numbered(
        "SELECT event_date, CAST(net_revenue AS DOUBLE) AS net_revenue, net_units, invoice_count, customer_count, "
        f"cancellation_lines FROM {daily}",
        "event_date ASC",
    )
    q["report_country"] = silver_gold + "\n" + _numbered(
        "SELECT country, CAST(net_revenue AS DOUBLE) AS net_revenue, line_count, invoice_count, customer_count, "
        f"net_revenue AS __rev FROM ({GOLD_COUNTRY.format(src='silver')})",
        "__rev DESC NULLS LAST, country ASC",
    ).replace("SELECT *,", "SELECT * EXCLUDE (__rev),", 1)
    q["report_top_products"] = silver_gold + f"""
SELECT * EXCLUDE (__rev), CAST(row_number() OVER (ORDER BY __rev DESC NULLS LAST, product_id ASC, product_name ASC) AS INTEGER) AS row_num
FROM (
  SELECT product_name, product_id, CAST(net_revenue AS DOUBLE) AS net_revenue, net_units, invoice_count, line_count,
         net_revenue AS __rev
  FROM ({GOLD_PRODUCT.format(src='silver')})
  ORDER BY net_revenue DESC NULLS LAST, product_id ASC, product_name ASC
  LIMIT 15
)"""
    q["report_order_status"] = silver_gold + f"""
SELECT order_status, CAST(net_revenue AS DOUBLE) AS net_revenue, net_units, invoice_count, line_count,
       CAST(row_number() OVER (ORDER BY net_revenue DESC NULLS LAST, order_status ASC, is_cancellation ASC) AS INTEGER) AS row_num
FROM ({GOLD_STATUS.format(src='silver')})"""
    q["report_health"] = _with(*OPS) + """
SELECT pipeline_step, last_status, last_run_at,
       CASE WHEN last_status = 'success' THEN 1 ELSE 0 END AS success_flag,
       CAST(row_number() OVER (ORDER BY pipeline_step ASC, last_run_at ASC) AS INTEGER) AS row_num
FROM health"""
    q["cancellation_rate"] = silver_gold + f"""
SELECT CAST(sum(CASE WHEN is_cancellation THEN line_count ELSE 0 END) AS DOUBLE) / CAST(sum(line_count) AS DOUBLE) AS cancellation_rate,
       CAST(sum(CASE WHEN is_cancellation THEN line_count ELSE 0 END) AS BIGINT) AS cancelled_lines,
       CAST(sum(line_count) AS BIGINT) AS line_count
FROM ({GOLD_STATUS.format(src='silver')})"""
    lake = _with(*LAKE)
    q["lake_landing"] = lake + f"\nSELECT {', '.join(LANDING)}, batch_id FROM lbr"
    q["lake_bronze"] = lake + f"\nSELECT {', '.join(LANDING)}, batch_id, event_date FROM lbr"
    q["lake_batch"] = lake + f"\nSELECT {', '.join(LANDING)}, event_date FROM lbr WHERE batch_id = 'lake-2'"
    q["lake_silver"] = lake + f"\nSELECT {', '.join(c for c in SILVER_OUT if c != 'source_file')} FROM silver"
    flagged = f"""
lfs AS (SELECT *, count(*) OVER (PARTITION BY order_id) > 1 AS __duplicate_order_id FROM silver),
lagg AS (SELECT {_count_ifs()}, count(*) AS total FROM lfs)"""
    q["lake_dq_results"] = _with(*LAKE, flagged) + "\n" + results_from("lagg", "'lake-2'")
    q["lake_rejected"] = _with(*LAKE, flagged) + "\n" + "\nUNION ALL\n".join(
        f"SELECT order_id, invoice_no, stock_code, quantity, unit_price, country, 'lake-2' AS run_id, '{name}' AS check_name, '{severity}' AS severity FROM lfs WHERE {predicate}"
        for name, severity, _, _, predicate in CHECKS
    )
    critical = " + ".join(f"f{i}" for i, (_, severity, *_) in enumerate(CHECKS) if severity == "critical")
    q["lake_run_log"] = _with(*LAKE, flagged) + f"""
SELECT batch_id AS run_id, 'bronze_orders' AS pipeline_step, 'success' AS status, count(*) AS row_count FROM lbr GROUP BY batch_id
UNION ALL SELECT 'lake-1', 'silver_orders', 'success', count(*) FROM lload1
UNION ALL SELECT 'lake-2', 'silver_orders', 'success', count(*) FROM lload2
UNION ALL SELECT 'lake-2', 'quality_checks', CASE WHEN {critical} > 0 THEN 'failed' ELSE 'success' END, 7 FROM lagg
UNION ALL SELECT 'lake-1', 'gold_aggregates', 'success', 2 + count(DISTINCT event_date) + count(DISTINCT (product_id, product_name)) + count(DISTINCT country) + count(DISTINCT (order_status, is_cancellation)) FROM lload1
UNION ALL SELECT 'lake-2', 'gold_aggregates', 'success', 5 + count(DISTINCT event_date) + count(DISTINCT (product_id, product_name)) + count(DISTINCT country) + count(DISTINCT (order_status, is_cancellation)) FROM silver"""
    for name, select in rebuilt.items():
        q[f"lake_gold_{name}"] = lake + select.format(src="silver")
    for name in ("kpis", "daily_trend", "country", "top_products", "order_status"):
        q[f"catalog_{name}"] = lake + q[f"report_{name}"].removeprefix(silver_gold)
    days = _with(*LAKE_OF_DAYS)
    q["lake_gold_daily_sales"] = days + rebuilt["daily_sales"].format(src="silver")
    q["catalog_daily_trend"] = days + q["report_daily_trend"].removeprefix(silver_gold)
    q["catalog_health"] = _with(*LAKE, flagged) + f"""
SELECT *, CAST(row_number() OVER (ORDER BY pipeline_step) AS INTEGER) AS row_num FROM (
  SELECT step AS pipeline_step, status AS last_status, CASE status WHEN 'success' THEN 1 ELSE 0 END AS success_flag
  FROM (
    SELECT unnest(['bronze_orders', 'silver_orders', 'gold_aggregates']) AS step, 'success' AS status
    UNION ALL SELECT 'quality_checks', CASE WHEN {critical} > 0 THEN 'failed' ELSE 'success' END FROM lagg
    UNION ALL SELECT 'data_quality_summary', CASE WHEN {" + ".join(f"f{i}" for i in range(len(CHECKS)))} > 0 THEN 'failed' ELSE 'success' END FROM lagg
  )
)"""
    q["change_classes"] = CHANGE_CLASSES
    q["backfill_range"] = _with(
        *BACKFILL,
        """
per_day AS (SELECT run_date, count(*) AS bronze_rows FROM bbr GROUP BY run_date),
first_seen AS (
  SELECT order_id, min(run_date) AS run_date FROM bty
  WHERE order_id IS NOT NULL AND updated_at IS NOT NULL GROUP BY order_id
),
new_keys AS (SELECT run_date, count(*) AS new_keys FROM first_seen GROUP BY run_date),
summary AS (
  SELECT d.run_date,
         (SELECT p FROM prefix) || '-landing-' || strftime(d.run_date, '%Y-%m-%d') AS landing_batch_id,
         CAST(coalesce(pd.bronze_rows, 0) AS BIGINT) AS bronze_rows,
         CAST(coalesce(nk.new_keys, 0) AS BIGINT) AS new_keys
  FROM days d LEFT JOIN per_day pd ON d.run_date = pd.run_date LEFT JOIN new_keys nk ON d.run_date = nk.run_date
)""",
    ) + """
SELECT *, CAST(sum(new_keys) OVER (ORDER BY run_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS silver_rows
FROM summary"""
    # After each day, the rows of Silver are looked up afresh: the latest line of every customer and line number so far.
    q["backfill_states"] = _with(
        LINES,
        FAULTY,
        f"""
bounds AS (SELECT DATE '{BACKFILL_CUTOVER}' AS s, max(CAST(InvoiceDate AS DATE)) AS e FROM lines),
days AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS run_date FROM bounds)""",
        events("faulty", "sev", arrival="CAST(InvoiceDate AS DATE)"),
        bronze("sev", "sbr"),
        typed("sbr", "sty"),
        stage("(SELECT * FROM sty)", "day_won", "customer_id, line_no, bronze_batch_id"),
        f"""
held AS (SELECT *, CAST(substr(bronze_batch_id, 6, 10) AS DATE) AS since FROM day_won),
asked AS (SELECT run_date, customer_id, line_no FROM days, (SELECT DISTINCT customer_id, line_no FROM held)),
state AS (
  SELECT a.run_date, h.* FROM asked a
  ASOF JOIN held h ON a.customer_id = h.customer_id AND a.line_no = h.line_no AND a.run_date >= h.since
),
flagged AS (SELECT run_date, {", ".join(f"({p}) AS f{i}" for i, (*_, p) in enumerate(CHECKS) if i != 1)} FROM state),
counted AS (SELECT run_date, count(*) AS silver_rows, {", ".join(f"count_if(f{i}) AS f{i}" for i in range(len(CHECKS)) if i != 1)} FROM flagged GROUP BY run_date),
twice AS (
  SELECT run_date, sum(n) AS f1 FROM (SELECT run_date, order_id, count(*) AS n FROM state GROUP BY ALL HAVING count(*) > 1) GROUP BY run_date
),
found AS (
  SELECT d.run_date, coalesce(silver_rows, 0) AS silver_rows, {", ".join(f"coalesce(f{i}, 0) AS f{i}" for i in range(len(CHECKS)))}
  FROM days d LEFT JOIN counted c ON d.run_date = c.run_date LEFT JOIN twice t ON d.run_date = t.run_date
)""",
    ) + f"""
SELECT run_date, CAST(silver_rows AS BIGINT) AS silver_rows,
       CAST({" + ".join(f"CAST(f{i} > 0 AS INTEGER)" for i in range(len(CHECKS)))} AS BIGINT) AS quality_failures,
       {", ".join(f"CAST(f{i} AS BIGINT) AS {name}" for i, (name, *_) in enumerate(CHECKS))}
FROM found"""
    q["backfill_silver"] = _with(*BACKFILL, stage("bty", "bsl", "order_id", then_by="run_date ASC NULLS FIRST")) + (
        f"\nSELECT {SILVER_COLS} FROM bsl"
    )
    return q
