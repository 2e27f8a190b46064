"""Registered queries of the training-data operators, one for each."""

from __future__ import annotations

from retention.llm import (
    chunk_dedup, decontaminate, fill_in_middle, line_templates, mixture, packing, ppm, preferences, quality_rules,
    ranked_search, repeated_bytes, simhash, token_store,
)

QUERIES = {
    "op1_line_templates": line_templates.query,
    "op2_gear_chunks": chunk_dedup.query,
    "op3_run_index": repeated_bytes.query,
    "op4_token_lists": token_store.query,
    "op5_preference_pairs": preferences.query,
    "op6_simhash_balls": simhash.query,
    "op7_winnowing": decontaminate.query,
    "op8_certified_rules": quality_rules.query,
    "op9_best_fit": packing.query,
    "op10_ppm": ppm.query,
    "op11_k2_treap": ranked_search.query,
    "op12_skip_list_fim": fill_in_middle.query,
    "op13_entropy_balancing": mixture.query,
}

SQL: dict[str, str] = {
    "op5_preference_pairs": preferences.SQL,
    "op7_winnowing": decontaminate.SQL,
    "op11_k2_treap": ranked_search.SQL,
    "op12_skip_list_fim": fill_in_middle.SQL,
}
