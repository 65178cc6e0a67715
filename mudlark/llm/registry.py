"""Queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from mudlark.llm import best_fit_packing, context_tree, fingerprints, language_id, license_scan, line_dedup, minhash_dedup, quality_rules, source_mixing, suffix_dedup, token_counts, vector_codes, whitening

MODULES = (best_fit_packing, context_tree, fingerprints, language_id, license_scan, line_dedup, minhash_dedup, quality_rules, source_mixing, suffix_dedup, token_counts, vector_codes, whitening)


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in MODULES for k, v in getattr(m, "ORACLE_SQL", {}).items()}
