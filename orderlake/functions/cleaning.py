"""Column expressions that turn raw invoice lines into landing order events.

Every function takes and returns a ``Column``; nothing here runs Python per row.
The session time zone must be UTC (see ``orderlake.session.use_utc``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType

# --- Fixed values: these literals must equal the reference's landing records ---
SOURCE_SYSTEM = "uci_online_retail"
CURRENCY = "GBP"
CHANNEL = "online_retail"
STATUS_CANCELLED = "cancelled"
STATUS_COMPLETED = "completed"
CANCELLATION_PREFIX = "C"
ARRIVAL_HOUR_UTC = "12:00:00"
LINE_KEY_SEPARATOR = "|"
LINE_KEY_TIME_FORMAT = "yyyyMMddHHmmss"
# --- end of fixed values ---

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

# Leading/trailing whitespace as Python's str.strip() sees it: Unicode White_Space
# plus the four ASCII information separators. Spark's trim() strips spaces only.
_EDGE_WHITESPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _is_float(dtype: DataType | None) -> bool:
    return isinstance(dtype, (DoubleType, FloatType))


def is_nan(c: Column | str, dtype: DataType | None = None) -> Column:
    """NaN test; only floating columns can hold NaN, everything else is ``false``."""
    if _is_float(dtype):
        return F.coalesce(F.isnan(_col(c)), F.lit(False))
    return F.lit(False)


def clean_string(c: Column | str, dtype: DataType | None = None) -> Column:
    """NULL or NaN -> ``""``; otherwise the text with edge whitespace removed."""
    c = _col(c)
    text = c if isinstance(dtype, StringType) else c.cast("string")
    if _is_float(dtype):
        text = F.when(F.isnan(c), F.lit(None).cast("string")).otherwise(text)
    return F.coalesce(F.regexp_replace(text, _EDGE_WHITESPACE, ""), F.lit(""))


def _whole(c: Column, dtype: DataType | None) -> Column:
    value = c.try_cast("bigint")
    if isinstance(dtype, StringType):  # "6.7" is a number too
        value = F.coalesce(value, c.try_cast("decimal(38,18)").try_cast("bigint"))
    return F.when(~F.isnan(c), value) if _is_float(dtype) else value


def _exact(c: Column, dtype: DataType | None) -> Column:
    # up to 20 digits before the point with 18 places behind it; up to 36 digits otherwise
    value = F.coalesce(F.bround(c.try_cast("decimal(38,18)"), 2).cast("decimal(38,2)"), c.try_cast("decimal(38,2)"))
    return F.when(~F.isnan(c), value) if _is_float(dtype) else value


def parse_int(c: Column | str, dtype: DataType | None = None) -> Column:
    """NULL/NaN/unparseable -> 0, otherwise truncated toward zero, as ``bigint``."""
    return F.coalesce(_whole(_col(c), dtype), F.lit(0).cast("bigint"))


def parse_decimal(c: Column | str, dtype: DataType | None = None) -> Column:
    """Two-place decimal rounded half-to-even; NULL/NaN/bad input -> 0.00.

    A double is converted through its shortest decimal text (as Spark's cast does),
    so 0.125 -> 0.12 and 0.135 -> 0.14. A plain decimal cast would round half-up.
    """
    return F.coalesce(_exact(_col(c), dtype), F.lit(0).cast("decimal(38,2)"))


def unreadable(c: Column | str, dtype: DataType | None = None, kind: str = "int") -> Column:
    """A value that is there, but that ``parse_int`` (``kind`` "int") or ``parse_decimal`` made zero."""
    c = _col(c)
    value = _whole(c, dtype) if kind == "int" else _exact(c, dtype)
    there = c.isNotNull() & ~is_nan(c, dtype)
    return there & value.isNull()


def parse_datetime(c: Column | str, dtype: DataType | None = None) -> Column:
    """ISO text (offset or ``Z``) or a native timestamp -> UTC ``timestamp``.

    Naive values are read as UTC because the session zone is UTC.
    """
    c = _col(c)
    if dtype is None or isinstance(dtype, StringType):
        return F.try_to_timestamp(c)
    return c.cast("timestamp")


def iso_utc(ts: Column | str) -> Column:
    """``2010-12-01T08:26:00Z``; microseconds are printed only when present."""
    ts = _col(ts).cast("timestamp")
    whole_second = (F.unix_micros(ts) % F.lit(1_000_000)) == 0
    return F.when(whole_second, F.date_format(ts, ISO_SECONDS)).otherwise(
        F.date_format(ts, ISO_MICROS)
    )


def line_key(invoice_no: Column, stock_code: Column, invoice_ts: Column) -> Column:
    """Natural key ``invoice|stock|yyyyMMddHHmmss`` of one invoice line."""
    return F.concat_ws(
        LINE_KEY_SEPARATOR,
        invoice_no,
        stock_code,
        F.date_format(invoice_ts, LINE_KEY_TIME_FORMAT),
    )


def is_cancellation(invoice_no: Column) -> Column:
    """Invoices whose number starts with ``C`` (any case) are cancellations."""
    return F.upper(invoice_no).startswith(CANCELLATION_PREFIX)


def order_status(cancelled: Column) -> Column:
    return F.when(cancelled, F.lit(STATUS_CANCELLED)).otherwise(F.lit(STATUS_COMPLETED))


def arrival_stamp(day: Column) -> Column:
    """The record version of a line that arrived on ``day``: noon UTC as ISO text."""
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T" + ARRIVAL_HOUR_UTC + "Z"))
