"""Registered queries of the training-data operators and, where SQL can express one, its oracle."""

from __future__ import annotations

from pulseframe.llm import (adaptive_rules, best_fit_packing, chat_format, decontaminate, exact_top_k,
                            importance_resampling, license_join, ngram_join, pii, pu_quality, spelling_variants, toxicity, warc_zip)

QUERIES = {
    "op1_chat_prefix_targets": chat_format.query,
    "op2_toxicity_severity": toxicity.query,
    "op3_ngram_jaccard_join": ngram_join.query,
    "op4_pii_spans": pii.query,
    "op5_benchmark_decontamination": decontaminate.query,
    "op6_best_fit_packing": best_fit_packing.query,
    "op7_license_set_join": license_join.query,
    "op8_pu_quality": pu_quality.query,
    "op9_warc_zip": warc_zip.query,
    "op10_adaptive_quality_rules": adaptive_rules.query,
    "op11_spelling_variants": spelling_variants.query,
    "op12_exact_top_k": exact_top_k.query,
    "op13_importance_resampling": importance_resampling.query,
}
ORACLE: dict[str, str] = {
    "op1_chat_prefix_targets": chat_format.ORACLE,
    "op7_license_set_join": license_join.ORACLE,
    "op9_warc_zip": warc_zip.ORACLE,
    "op11_spelling_variants": spelling_variants.ORACLE,
    "op12_exact_top_k": exact_top_k.ORACLE,
    "op13_importance_resampling": importance_resampling.ORACLE,
}
