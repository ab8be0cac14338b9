"""The registered queries of this folder and their check SQL."""

from __future__ import annotations

from hazeline.llm import q_alignment, q_bpe, q_jaccard, q_language, q_mixing, q_pages, q_rollups, q_scoring, q_spelling, q_substrings, q_vectors

QUERIES = {
    "op1_language": q_language.op1_language,
    "op2_substrings": q_substrings.op2_substrings,
    "op3_jaccard": q_jaccard.op3_jaccard,
    "op4_rollups": q_rollups.op4_rollups,
    "op5_nearest": q_vectors.op5_nearest,
    "op6_mixing": q_mixing.op6_mixing,
    "op7_extraction": q_pages.op7_extraction,
    "op8_warc": q_pages.op8_warc,
    "op9_bpe": q_bpe.op9_bpe,
    "op10_top_products": q_vectors.op10_top_products,
    "op11_scoring": q_scoring.op11_scoring,
    "op12_alignment": q_alignment.op12_alignment,
    "op13_spelling": q_spelling.op13_spelling,
}
CHECKS = {
    "op2_substrings": q_substrings.SQL,
    "op3_jaccard": q_jaccard.SQL,
    "op4_rollups": q_rollups.SQL,
    "op6_mixing": q_mixing.SQL,
    "op8_warc": q_pages.ARCHIVED,
    "op10_top_products": q_vectors.PRODUCTS,
}
