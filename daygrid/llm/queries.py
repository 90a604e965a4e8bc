"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline

from . import bpe, conversations, fingerprints, html_wrappers, licenses, lm, mixing, neardup, quality, secrets, substrings, toxicity, whitening

QUERIES = {
    "op1_mix_sources": mixing.op1,
    "op2_minhash_dedup": neardup.op2,
    "op3_toxicity": toxicity.op3,
    "op4_quality_rules": quality.op4,
    "op5_secret_scan": secrets.op5,
    "op6_bpe_round_trip": bpe.op6,
    "op7_html_wrappers": html_wrappers.op7,
    "op8_substring_dedup": substrings.op8,
    "op9_fingerprints": fingerprints.op9,
    "op10_license_scan": licenses.op10,
    "op11_ppm_score": lm.op11,
    "op12_whitening": whitening.op12,
    "op13_conversation_repair": conversations.op13,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op1_mix_sources": mixing.SQL,
    "op2_minhash_dedup": neardup.SQL,
    "op4_quality_rules": quality.SQL,
    "op8_substring_dedup": substrings.SQL,
}
