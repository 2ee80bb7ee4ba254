"""The training-data queries by name, and SQL for those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, html_text, near_dup, packing, quality, resampling, secret_scan, sharding, suffix_dedup, token_files, toxicity, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_shard": sharding.op1_shard,
    "op2_near_duplicates": near_dup.op2_near_duplicates,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_warc_archive": warc.op4_warc_archive,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_html_text": html_text.op7_html_text,
    "op8_token_files": token_files.op8_token_files,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_whitening": whitening.op11_whitening,
    "op12_secret_scan": secret_scan.op12_secret_scan,
    "op13_resample": resampling.op13_resample,
}
ORACLE_SQL: dict[str, str] = {"op2_near_duplicates": near_dup.OP2_SQL, "op4_warc_archive": warc.OP4_SQL, "op13_resample": resampling.OP13_SQL}
