"""Queries of the numbered operators, and their SQL where SQL can express them."""

from __future__ import annotations

from ledgerline.llm import decontaminate, exact_dedup, filter_audit, merkle, minhash, packing, pii, prefix_tokens, quality, repeats, secrets, token_files, toxicity

QUERIES = {
    "op1_personal_data": pii.op1_personal_data,
    "op2_secret_scan": secrets.op2_secret_scan,
    "op3_token_counts": prefix_tokens.op3_token_counts,
    "op4_decontamination": decontaminate.op4_decontamination,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_suffix_dedup": repeats.op7_suffix_dedup,
    "op8_minhash": minhash.op8_minhash,
    "op9_token_files": token_files.op9_token_files,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_quality": quality.op13_quality,
}

ORACLE = {**decontaminate.SQL, **exact_dedup.SQL, **merkle.SQL, **filter_audit.SQL}
