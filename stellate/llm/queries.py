"""The registered query of each operator, with production parameters over whole tables, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stellate.llm import fingerprints, lattice, leaks, lines, mix, near, phrases, quality, repeats, secrets, tokens, turns, urls


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix": mix.op1_mix,
        "op2_lm_scoring": lattice.op2_lm_scoring,
        "op3_line_dedup": lines.op3_line_dedup,
        "op4_url_filters": urls.op4_url_filters,
        "op5_secret_scans": secrets.op5_secrets,
        "op6_near_dedup": near.op6_near_dedup,
        "op7_token_counts": tokens.op7_token_counts,
        "op8_quality_rules": quality.op8_quality,
        "op9_decontamination": leaks.op9_decontamination,
        "op10_repeats": repeats.op10_repeats,
        "op11_phrases": phrases.op11_phrases,
        "op12_turns": turns.op12_turns,
        "op13_fingerprints": fingerprints.op13_fingerprints,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_dedup": lines.OP3_SQL,
        "op4_url_filters": urls.OP4_SQL,
        "op8_quality_rules": quality.OP8_SQL,
        "op11_phrases": phrases.OP11_SQL,
    }
