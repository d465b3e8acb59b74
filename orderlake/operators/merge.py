"""Upsert merge of staged rows into the current table (no transactional format needed).

``MERGE INTO target USING source ON keys WHEN MATCHED AND s.seq > t.seq UPDATE *
WHEN NOT MATCHED INSERT *`` expressed as one full outer join. Presence markers (not
``key IS NULL``) tell the sides apart, so a NULL-key target row is kept and a NULL
target ``seq`` never gets replaced (the guard is a strict, NULL-false comparison).
Both sides hold at most one row per key, so no key can be hot in this join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACTION_COL = "_merge_action"


def merge_latest(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str] = ("order_id",),
    seq: str = "updated_at",
    columns: Sequence[str] | None = None,
    track: Sequence[str] = (),
) -> DataFrame:
    """Return the merged table.

    With ``track`` (e.g. ``["event_date"]``) two more kinds of columns are added:
    ``_merge_action`` in ``insert | update | keep | target_only`` and, for each
    tracked column ``c``, ``_old_c`` with the target's value before the merge.
    """
    cols = list(columns or target.columns)
    missing = [c for c in cols if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks merge columns: {missing}")

    t = target.select(*[F.col(c).alias(f"__t_{c}") for c in cols], F.lit(True).alias("__t_present"))
    s = source.select(*[F.col(c).alias(f"__s_{c}") for c in cols], F.lit(True).alias("__s_present"))
    on = None
    for k in keys:
        cond = F.col(f"__t_{k}") == F.col(f"__s_{k}")
        on = cond if on is None else on & cond
    joined = t.join(s, on, "full_outer")

    t_present = F.col("__t_present").isNotNull()
    s_present = F.col("__s_present").isNotNull()
    newer = F.coalesce(F.col(f"__s_{seq}") > F.col(f"__t_{seq}"), F.lit(False))
    take_source = (~t_present) | (s_present & newer)

    out = [F.when(take_source, F.col(f"__s_{c}")).otherwise(F.col(f"__t_{c}")).alias(c) for c in cols]
    if track:
        action = (
            F.when(~t_present, F.lit("insert"))
            .when(~s_present, F.lit("target_only"))
            .when(newer, F.lit("update"))
            .otherwise(F.lit("keep"))
        )
        out.append(action.alias(ACTION_COL))
        out.extend(F.col(f"__t_{c}").alias(f"_old_{c}") for c in track)
    return joined.select(*out)


def changed_values(merged: DataFrame, column: str = "event_date") -> DataFrame:
    """Distinct old and new values of ``column`` over inserted or updated rows.

    A correction that moves a row to another date touches both partitions; NULL is a value too. Only
    updated rows have an old value.
    """
    action = F.col(ACTION_COL)
    new, old = F.struct(F.col(column).alias(column)), F.struct(F.col(f"_old_{column}").alias(column))
    values = F.when(action == "update", F.array(new, old)).otherwise(F.array(new))  # both images from one pass
    return merged.filter(action.isin("insert", "update")).select(F.inline(values)).distinct()
