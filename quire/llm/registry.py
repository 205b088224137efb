"""The queries of the corpus operators, and SQL where SQL can express them."""

from __future__ import annotations

from quire.llm import decontaminate, exact_dedup, language_id, line_dedup, mixing, secrets_scan, simhash, suffix_dedup, token_store, toxicity


def queries() -> dict:
    return {
        "op1_decontamination": decontaminate.op1_decontamination,
        "op2_language_id": language_id.op2_language_id,
        "op3_tokens": token_store.op3_tokens,
        "op4_suffix_dedup": suffix_dedup.op4_suffix_dedup,
        "op5_simhash": simhash.op5_simhash,
        "op6_secrets": secrets_scan.op6_secrets,
        "op7_exact_dedup": exact_dedup.op7_exact_dedup,
        "op8_mixing": mixing.op8_mixing,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_line_dedup": line_dedup.op10_line_dedup,
    }


def oracle_sql() -> dict:
    return {"op1_decontamination": decontaminate.OP1_SQL, "op7_exact_dedup": exact_dedup.OP7_SQL}
