"""The registered training-data queries and the SQL of those that SQL can express."""

from __future__ import annotations

from pvspark.llm import (
    q_chat, q_decontamination, q_embeddings, q_fuzzy_lines, q_infilling, q_mixing, q_nearest, q_pii, q_quality, q_repeats, q_sharding,
    q_simhash, q_variants,
)

QUERIES = {
    "op1_pii": q_pii.query,
    "op6_embeddings": q_embeddings.query,
    "op2_repeats": q_repeats.query,
    "op3_decontamination": q_decontamination.query,
    "op4_mixing": q_mixing.query,
    "op5_quality": q_quality.query,
    "op7_sharding": q_sharding.query,
    "op8_simhash": q_simhash.query,
    "op9_fuzzy_lines": q_fuzzy_lines.query,
    "op10_chat": q_chat.query,
    "op11_variants": q_variants.query,
    "op12_nearest": q_nearest.query,
    "op13_infilling": q_infilling.query,
}

ORACLE = {
    "op6_embeddings": q_embeddings.SQL,
    "op3_decontamination": q_decontamination.SQL,
    "op4_mixing": q_mixing.SQL,
    "op7_sharding": q_sharding.SQL,
    "op10_chat": q_chat.SQL,
    "op12_nearest": q_nearest.SQL,
    "op13_infilling": q_infilling.SQL,
}
