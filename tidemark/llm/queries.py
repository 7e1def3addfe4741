"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from tidemark.llm import (
    op1_mixing,
    op2_ann,
    op3_line_rules,
    op4_token_counts,
    op5_packing,
    op6_line_crf,
    op7_line_dedup,
    op8_html_text,
    op9_licenses,
    op10_ngram_join,
    op11_resampling,
    op12_substrings,
    op13_conversations,
)

QUERIES = {
    "op1_mixing": op1_mixing.op1_mixing,
    "op2_ann": op2_ann.op2_ann,
    "op3_line_rules": op3_line_rules.op3_line_rules,
    "op4_token_counts": op4_token_counts.op4_token_counts,
    "op5_packing": op5_packing.op5_packing,
    "op6_line_crf": op6_line_crf.op6_line_crf,
    "op7_line_dedup": op7_line_dedup.op7_line_dedup,
    "op8_html_text": op8_html_text.op8_html_text,
    "op9_licenses": op9_licenses.op9_licenses,
    "op10_ngram_join": op10_ngram_join.op10_ngram_join,
    "op11_resampling": op11_resampling.op11_resampling,
    "op12_substrings": op12_substrings.op12_substrings,
    "op13_conversations": op13_conversations.op13_conversations,
}

ORACLE = {
    "op3_line_rules": op3_line_rules.SQL,
    "op7_line_dedup": op7_line_dedup.SQL,
    "op10_ngram_join": op10_ngram_join.SQL,
    "op11_resampling": op11_resampling.SQL,
    "op12_substrings": op12_substrings.SQL,
    "op13_conversations": op13_conversations.SQL,
}
