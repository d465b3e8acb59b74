"""Bronze enrichment: raw payload, lineage, ingest clock and the partition date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.sources.schemas import BRONZE_COLUMNS, LANDING_COLUMNS


def _value(v: str | Column) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def partition_date() -> Column:
    """The UTC calendar date written in ``event_time``."""
    return F.col("event_time").try_cast("date")


def prepare_bronze(
    events: DataFrame,
    batch_id: str | Column,
    source_file: str | Column = "unknown",
    ingested_at: Column | None = None,
) -> DataFrame:
    """Add ``raw_payload, source_file, batch_id, ingested_at, event_date`` to landing events.

    The payload is the JSON of the 16 landing fields in key order (landing files are
    written with sorted keys); partition columns of the landing path never enter it.
    ``event_date`` is the UTC calendar date written in ``event_time``.
    """
    payload_fields = sorted(c for c in LANDING_COLUMNS if c in events.columns)
    added = {
        "raw_payload": F.to_json(F.struct(*[F.col(c) for c in payload_fields])),
        "source_file": _value(source_file),
        "batch_id": _value(batch_id),
        "ingested_at": ingested_at if ingested_at is not None else F.current_timestamp(),
        "event_date": partition_date(),
    }
    cols = [added[c].alias(c) if c in added else F.col(c) for c in BRONZE_COLUMNS]
    extras = [F.col(c) for c in events.columns if c not in BRONZE_COLUMNS]
    return events.select(*cols, *extras)
