"""The corpus operators' queries (the pipeline registers beside them, in __spark_entry__.py) and, where SQL can express them, their SQL.

op2, op3, op5, op6, op7, op9, op10 and op12 have none: DuckDB has neither the tokenizers nor crc32, and iterated
components, HTML parsing and the lattice are beyond it or too slow on whole tables. tests/llm holds them
against brute force instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import audit, chat, decontam, dedup, html, license, lm, packing, phrases, quality, repair, shards, tokens


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": quality.query,
        "op2_near_duplicates": dedup.query,
        "op3_best_fit_packing": packing.query,
        "op4_chat_perspectives": chat.query,
        "op5_main_text": html.query,
        "op6_lattice_scores": lm.query,
        "op7_benchmark_leaks": decontam.query,
        "op8_license_scan": license.query,
        "op9_minimax_shards": shards.query,
        "op10_token_counts": tokens.query,
        "op11_substring_dedup": phrases.query,
        "op12_structure_repair": repair.query,
        "op13_filter_audit": audit.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": quality.SQL, "op4_chat_perspectives": chat.SQL, "op8_license_scan": license.SQL, "op11_substring_dedup": phrases.SQL, "op13_filter_audit": audit.SQL}
