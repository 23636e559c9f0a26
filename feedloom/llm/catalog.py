"""The queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from feedloom.llm import chat, decontam, dedup, html, licenses, media, pieces, pii, quality, toxicity

QUERIES = {
    "op1_quality_classifier": quality.op1_quality_classifier,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_sentencepiece_sampling": pieces.op3_sentencepiece_sampling,
    "op4_html_extraction": html.op4_html_extraction,
    "op5_license_scan": licenses.op5_license_scan,
    "op6_media_columns": media.op6_media_columns,
    "op7_pii": pii.op7_pii,
    "op8_benchmark_decontamination": decontam.op8_benchmark_decontamination,
    "op9_minhash_near_dedup": dedup.op9_minhash_near_dedup,
    "op10_preference_format": chat.op10_preference_format,
}

SQL = {
    "op5_license_scan": licenses.OP5_SQL,
    "op9_minhash_near_dedup": dedup.OP9_SQL,
    "op10_preference_format": chat.OP10_SQL,
}
