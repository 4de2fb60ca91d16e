"""Queries of the training-data operators and their SQL equivalents."""

from __future__ import annotations

from corpusloom.llm import decontaminate, exact_dedup, knn, line_dedup, merkle, near_dup, prefix_trie, quality, secret_scan, sentencepiece_codec, substring_dedup, toxicity, url_filters

QUERIES = {
    "op1_quality": quality.op1_quality,
    "op2_sentencepiece": sentencepiece_codec.op2_sentencepiece,
    "op3_topk_search": knn.op3_topk_search,
    "op4_url_filters": url_filters.op4_url_filters,
    "op5_secret_scan": secret_scan.op5_secret_scan,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_decontamination": decontaminate.op7_decontamination,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_suffix_dedup": substring_dedup.op9_suffix_dedup,
    "op10_near_dup": near_dup.op10_near_dup,
    "op11_exact_dedup": exact_dedup.op11_exact_dedup,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}
ORACLE_SQL = {
    "op3_topk_search": knn.OP3_SQL,
    "op4_url_filters": url_filters.OP4_SQL,
    "op11_exact_dedup": exact_dedup.OP11_SQL,
    "op12_prefix_trie": prefix_trie.OP12_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
}
