"""Queries of this package and their DuckDB SQL.

Without SQL are the queries that hold a fitted model or a similarity search;
their tests compare with brute force or held-out labels.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeviews.llm import (decontamination, fill_middle, jaccard_join, language, licenses, line_dedup, mixing, periodic_runs,
                           quality_model, quality_rules, secrets, suffix_dedup, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": mixing.op1_mix,
    "op2_decontamination": decontamination.op2_decontamination,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_language": language.op4_language,
    "op5_secrets": secrets.op5_secrets,
    "op6_jaccard_join": jaccard_join.op6_jaccard_join,
    "op7_quality_model": quality_model.op7_quality_model,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_licenses": licenses.op10_licenses,
    "op11_fill_middle": fill_middle.op11_fill_middle,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_line_dedup": line_dedup.op13_line_dedup,
}

ORACLES: dict[str, str] = {
    "op1_mix": mixing.OP1_SQL,
    "op8_quality_rules": quality_rules.OP8_SQL,
    "op10_licenses": licenses.op10_sql(),
    "op11_fill_middle": fill_middle.OP11_SQL,
    "op13_line_dedup": line_dedup.OP13_SQL,
}
