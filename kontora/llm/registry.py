"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from importlib import import_module

MODULES = {
    "secret_scan": "op1_secret_scans",
    "line_dedup": "op2_line_dedup",
    "packing": "op3_best_fit_packing",
    "license_scan": "op4_license_scans",
    "language_id": "op5_language_id",
    "decontamination": "op6_benchmark_decontamination",
    "media_gif": "op7_media_columns",
    "near_dedup": "op8_minhash_near_dedup",
    "toxicity": "op9_toxicity",
    "url_filter": "op10_url_filters",
}


def queries() -> dict:
    return {q: getattr(import_module(f"kontora.llm.{m}"), q) for m, q in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    found = {q: getattr(import_module(f"kontora.llm.{m}"), "ORACLE", None) for m, q in MODULES.items()}
    return {q: sql for q, sql in found.items() if sql}
