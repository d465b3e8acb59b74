"""A staged table that a query uses several times is shuffled once: its exchanges are equal, so Spark reuses them."""

from __future__ import annotations

import re

import pytest

from conftest import SF_SMALL
from orderlake.plans import registry as R


def exchanges(df, keys):
    """The plans below each exchange on ``keys``, without the numbers of their columns."""
    text = df._jdf.queryExecution().executedPlan().toString()
    lines = re.sub(r"#\d+L?|\[plan_id=\d+\]|\d{4}-\d\d-\d\d \d\d:\d\d:\d\d\.\d+", "", text).splitlines()
    depth = [len(re.match(r"[ :+|-]*", line)[0]) for line in lines]
    found = []
    for i, line in enumerate(lines):
        if f"Exchange hashpartitioning({keys}, " in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            found.append("\n".join(x.lstrip(" :+|-") for x in lines[i:end]))
    return found


@pytest.mark.parametrize(
    ("name", "keys", "loads"),
    [("distinct_by_country", "order_id", 1), ("distinct_by_month", "customer_id, line_no", 2), ("backfill_states", "customer_id, line_no, run_date", 1)],
)
def test_a_staged_table_is_shuffled_once(spark, name, keys, loads):
    found = exchanges(R.QUERIES[name](spark, SF_SMALL), keys)
    assert len(found) > loads and len(set(found)) == loads, "\n\n".join(sorted(set(found)))[:3000]
