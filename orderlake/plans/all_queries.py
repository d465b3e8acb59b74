"""All queries of the library: over the given tables, and over the lake that the jobs write from them."""

from __future__ import annotations

from orderlake.plans.lake_queries import QUERIES as _ON_LAKE
from orderlake.plans.registry import QUERIES as _ON_TABLES

QUERIES = {**_ON_TABLES, **_ON_LAKE}
