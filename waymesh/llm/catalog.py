"""The queries of this sub-package, and their DuckDB texts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waymesh.llm import op01_language, op02_token_counts, op03_fingerprints, op04_quality, op05_decontamination, op06_token_ids, op07_warc, op08_html, op09_mixing, op10_minhash


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language": op01_language.query,
        "op2_token_counts": op02_token_counts.query,
        "op3_fingerprints": op03_fingerprints.query,
        "op4_quality": op04_quality.query,
        "op5_decontamination": op05_decontamination.query,
        "op6_token_ids": op06_token_ids.query,
        "op7_warc": op07_warc.query,
        "op8_html": op08_html.query,
        "op9_mixing": op09_mixing.query,
        "op10_minhash": op10_minhash.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_warc": op07_warc.ORACLE,
        "op9_mixing": op09_mixing.ORACLE,
        "op10_minhash": op10_minhash.ORACLE,
    }
