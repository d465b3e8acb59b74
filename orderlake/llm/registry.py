"""The queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderlake.llm.conversation_repair import op12_conversation_repair
from orderlake.llm.cross_polytope import op2_cross_polytope
from orderlake.llm.language_id import op5_language_id
from orderlake.llm.near_dedup import op7_near_dedup
from orderlake.llm.packing import op4_packing
from orderlake.llm.page_text import op13_page_text
from orderlake.llm.quotations import OP6_SQL, op6_quotations
from orderlake.llm.ship import shipped
from orderlake.llm.spelling_variants import op11_spelling_variants
from orderlake.llm.substring_dedup import OP1_SQL, op1_substring_dedup
from orderlake.llm.surrogates import op8_surrogates
from orderlake.llm.templates import op10_templates
from orderlake.llm.token_counts import op9_token_counts
from orderlake.llm.token_records import op3_token_records

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_cross_polytope": op2_cross_polytope,
    "op3_token_records": op3_token_records,
    "op4_packing": op4_packing,
    "op5_language_id": op5_language_id,
    "op6_quotations": op6_quotations,
    "op7_near_dedup": op7_near_dedup,
    "op8_surrogates": op8_surrogates,
    "op9_token_counts": op9_token_counts,
    "op10_templates": op10_templates,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_page_text": op13_page_text,
}

QUERIES = {name: shipped(query) for name, query in QUERIES.items()}

ORACLES: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op6_quotations": OP6_SQL,
}
