"""The queries of this folder and their SQL; both are added to the contract's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    decontaminate,
    extraction,
    fingerprints,
    licenses,
    mixing,
    neardup,
    quality,
    resampling,
    search,
    secrets,
    suffix_dedup,
    token_files,
    tokens,
)
from tidemark.llm.common import ships_package

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    found = {
        "op1_license_scan": licenses.op1_license_scan,
        "op2_token_counts": tokens.op2_token_counts,
        "op3_html_extraction": extraction.op3_html_extraction,
        "op4_mix_sources": mixing.op4_mix_sources,
        "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
        "op6_decontamination": decontaminate.op6_decontamination,
        "op7_token_files": token_files.op7_token_files,
        "op8_near_duplicates": neardup.op8_near_duplicates,
        "op9_quality_rules": quality.op9_quality_rules,
        "op10_secret_scan": secrets.op10_secret_scan,
        "op11_resampling": resampling.op11_resampling,
        "op12_search": search.op12_search,
        "op13_fingerprints": fingerprints.op13_fingerprints,
    }
    return {name: ships_package(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_mix_sources": mixing.OP4_SQL,
        "op6_decontamination": decontaminate.OP6_SQL,
        "op8_near_duplicates": neardup.OP8_SQL,
        "op11_resampling": resampling.OP11_SQL,
        "op12_search": search.OP12_SQL,
    }
