"""Registered queries of this package and their SQL."""

from __future__ import annotations

from stratum.llm import (
    chat_examples,
    class_ngrams,
    conversation_repair,
    decontaminate,
    knn_quality,
    license_scan,
    line_runs,
    quality_votes,
    secret_scan,
    segment_search,
    simhash_trie,
    source_mix,
    spelling_groups,
)

QUERIES = {
    "op1_licenses": license_scan.op1_licenses,
    "op2_secrets": secret_scan.op2_secrets,
    "op3_chat_format": chat_examples.op3_chat_format,
    "op4_quality": knn_quality.op4_quality,
    "op5_class_lm": class_ngrams.op5_class_lm,
    "op6_mix": source_mix.op6_mix,
    "op7_simhash_dedup": simhash_trie.op7_simhash_dedup,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_line_dedup": line_runs.op9_line_dedup,
    "op10_topk": segment_search.op10_topk,
    "op11_repair": conversation_repair.op11_repair,
    "op12_quality_rules": quality_votes.op12_quality_rules,
    "op13_spelling": spelling_groups.op13_spelling,
}

ORACLE = {
    "op3_chat_format": chat_examples.OP3_SQL,
    "op8_decontaminate": decontaminate.OP8_SQL,
    "op9_line_dedup": line_runs.OP9_SQL,
    "op10_topk": segment_search.OP10_SQL,
    "op11_repair": conversation_repair.OP11_SQL,
    "op13_spelling": spelling_groups.OP13_SQL,
}
