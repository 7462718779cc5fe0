"""The queries of this subpackage and their SQL."""

from __future__ import annotations

import corpus_pipeline
from sensorium.llm import (
    chat, exact_dedup, html_extract, lexical_search, licenses, mixing, ngram_join, packing, pii, quality, spelling,
    token_counts, url_filter,
)

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_ngram_jaccard": ngram_join.op2_ngram_jaccard,
    "op3_html_extraction": html_extract.op3_html_extraction,
    "op4_url_filters": url_filter.op4_url_filters,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_mixing": mixing.op6_mixing,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_private_data": pii.op8_private_data,
    "op9_chat_formatting": chat.op9_chat_formatting,
    "op10_license_scans": licenses.op10_license_scans,
    "op11_lexical_search": lexical_search.op11_lexical_search,
    "op12_token_counts": token_counts.op12_token_counts,
    "op13_spelling_variants": spelling.op13_spelling_variants,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op4_url_filters": url_filter.ORACLE,
    "op7_exact_dedup": exact_dedup.ORACLE,
    "op9_chat_formatting": chat.ORACLE,
    "op11_lexical_search": lexical_search.ORACLE,
}

if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
