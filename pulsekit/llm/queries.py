"""The corpus operators as queries, with their DuckDB text where SQL can express them."""

from __future__ import annotations

from pulsekit.llm import (bpe, licences, merge_replay, mixing, near_dedup, quality, ranked_search, repeats, secrets, substring, topk,
                          toxicity, vector_codes)

QUERIES = {
    "op1_repeated_passages": substring.op1_repeated_passages,
    "op2_bpe_round_trip": bpe.op2_bpe_round_trip,
    "op3_mix_sources": mixing.op3_mix_sources,
    "op4_near_dedup": near_dedup.op4_near_dedup,
    "op5_repeat_removal": repeats.op5_repeat_removal,
    "op6_licence_scan": licences.op6_licence_scan,
    "op7_quality_rules": quality.op7_quality_rules,
    "op8_exact_top_k": topk.op8_exact_top_k,
    "op9_secret_scan": secrets.op9_secret_scan,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_ranked_search": ranked_search.op12_ranked_search,
    "op13_merge_replay": merge_replay.op13_merge_replay,
}

SQL = {
    "op3_mix_sources": mixing.SQL_MIX,
    "op4_near_dedup": near_dedup.SQL_NEAR,
    "op6_licence_scan": licences.SQL_LICENCES,
    "op8_exact_top_k": topk.SQL_TOP_K,
    "op9_secret_scan": secrets.SQL_SECRETS,
    "op11_vector_codes": vector_codes.SQL_CODES,
    "op12_ranked_search": ranked_search.SQL_SEARCH,
}
