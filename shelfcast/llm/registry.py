"""The queries of this folder and the SQL that each is checked against."""

from __future__ import annotations

from shelfcast.llm import bit_search, byte_pairs, cap_links, line_spread, mask_search, piece_scan, shingle_join, site_quality, source_mix, suffix_dedup, token_links, toxic_spans, url_rules

QUERIES = {
    "op1_embedding_dedup": cap_links.query,
    "op2_suffix_dedup": suffix_dedup.query,
    "op3_nearest": bit_search.query,
    "op4_toxicity": toxic_spans.query,
    "op5_line_dedup": line_spread.query,
    "op6_url_filters": url_rules.query,
    "op7_shingle_join": shingle_join.query,
    "op8_site_quality": site_quality.query,
    "op9_sentencepiece": piece_scan.query,
    "op10_source_mix": source_mix.query,
    "op11_mask_search": mask_search.query,
    "op12_token_links": token_links.query,
    "op13_byte_pairs": byte_pairs.query,
}

SQL = {
    "op5_line_dedup": line_spread.ORACLE_SQL,
    "op6_url_filters": url_rules.ORACLE_SQL,
    "op11_mask_search": mask_search.ORACLE_SQL,
}
