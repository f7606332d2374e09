"""Registered queries of the corpus operators, and their DuckDB SQL."""

from __future__ import annotations

from . import (embedding_dedup, exact_dedup, line_dedup, merkle, mixing, near_dedup, packing, quality, secrets,
               substring_dedup, token_counts, toxicity, whitening)

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_secrets": secrets.op2_secrets,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_mixing": mixing.op4_mixing,
    "op5_packing": packing.op5_packing,
    "op6_near_dedup": near_dedup.op6_near_dedup,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_token_counts": token_counts.op10_token_counts,
    "op11_merkle": merkle.op11_merkle,
    "op12_whitening": whitening.op12_whitening,
    "op13_embedding_dedup": embedding_dedup.op13_embedding_dedup,
}

ORACLES = {
    "op1_quality": quality.OP1_SQL,
    "op4_mixing": mixing.OP4_SQL,
    "op7_exact_dedup": exact_dedup.OP7_SQL,
    "op9_substring_dedup": substring_dedup.OP9_SQL,
    "op11_merkle": merkle.OP11_SQL,
}
