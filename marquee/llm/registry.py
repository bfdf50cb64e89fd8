"""Queries and SQL of this subpackage, by name."""

from __future__ import annotations

from marquee.llm import (alignment, classifier, embedding_dedup, html_extract, language_id, line_dedup, mixing,
                         ngram_join, packing, quality_rules, sharding, whitening, window_lm)

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_lm_scoring": window_lm.op2_lm_scoring,
    "op3_ngram_jaccard_join": ngram_join.op3_ngram_jaccard_join,
    "op4_packing": packing.op4_packing,
    "op5_embedding_near_dedup": embedding_dedup.op5_embedding_near_dedup,
    "op6_mixing": mixing.op6_mixing,
    "op7_quality_classifier": classifier.op7_quality_classifier,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_html_extraction": html_extract.op9_html_extraction,
    "op10_sharding": sharding.op10_sharding,
    "op11_cross_tokenizer_alignment": alignment.op11_cross_tokenizer_alignment,
    "op12_language_id": language_id.op12_language_id,
    "op13_embedding_whitening": whitening.op13_embedding_whitening,
}

ORACLE = {
    "op1_quality_rules": quality_rules.QUALITY_SQL,
    "op3_ngram_jaccard_join": ngram_join.NGRAM_JOIN_SQL,
    "op5_embedding_near_dedup": embedding_dedup.EMBEDDING_DEDUP_SQL,
    "op6_mixing": mixing.MIXING_SQL,
    "op8_line_dedup": line_dedup.LINE_DEDUP_SQL,
}
