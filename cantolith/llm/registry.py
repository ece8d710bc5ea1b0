"""Queries opN_<name> of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import base, decontaminate, hard_negatives, html_text, jaccard_join, license_scan, mixing, near_dedup, quality_classifier, quality_rules, substring_dedup, token_count, url_filter, vector_codes


def queries() -> dict:
    """Query name -> callable(spark, sf_dir)."""
    import corpus_pipeline

    return {
        "pipeline": corpus_pipeline.run,
        "op1_license_scan": license_scan.op1_license_scan,
        "op2_html_text": html_text.op2_html_text,
        "op3_near_duplicates": near_dedup.op3_near_duplicates,
        "op4_url_filter": url_filter.op4_url_filter,
        "op5_token_counts": token_count.op5_token_counts,
        "op6_mixing": mixing.op6_mixing,
        "op7_quality_rules": quality_rules.op7_quality_rules,
        "op8_quality_classifier": quality_classifier.op8_quality_classifier,
        "op9_decontamination": decontaminate.op9_decontamination,
        "op10_substring_dedup": substring_dedup.op10_substring_dedup,
        "op11_jaccard_join": jaccard_join.op11_jaccard_join,
        "op12_vector_codes": vector_codes.op12_vector_codes,
        "op13_hard_negatives": hard_negatives.op13_hard_negatives,
        "license_base_phrases": base.license_base_phrases,
        "quality_base_counts": base.quality_base_counts,
    }


def oracle_sql() -> dict[str, str]:
    """Query name -> SQL, where SQL can express the query."""
    return {
        "op3_near_duplicates": base.NEAR_DUPLICATES,
        "op4_url_filter": url_filter.SQL,
        "op11_jaccard_join": jaccard_join.SQL,
        "op12_vector_codes": vector_codes.SQL,
        "op13_hard_negatives": hard_negatives.SQL,
        "license_base_phrases": base.LICENSE_BASE,
        "quality_base_counts": base.QUALITY_BASE,
    }
