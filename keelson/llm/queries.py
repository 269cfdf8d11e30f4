"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import decontaminate, exact_dedup, fill_in_middle, html_template, language_id, lm_mixing, packing, prefix_trie, quality_rules, sharding, simhash, suffix_dedup, url_rules

QUERIES = {
    "op1_html_extraction": html_template.op1_html_extraction,
    "op2_lm_scoring": lm_mixing.op2_lm_scoring,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_suffix_dedup": suffix_dedup.op4_suffix_dedup,
    "op5_url_filter": url_rules.op5_url_filter,
    "op6_decontamination": decontaminate.op6_decontamination,
    "op7_simhash": simhash.op7_simhash,
    "op8_language_id": language_id.op8_language_id,
    "op9_sharding": sharding.op9_sharding,
    "op10_packing": packing.op10_packing,
    "op11_fill_in_middle": fill_in_middle.op11_fill_in_middle,
    "op12_quality_rules": quality_rules.op12_quality_rules,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

SQL = {
    "op3_exact_dedup": exact_dedup.SQL,
    "op5_url_filter": url_rules.SQL,
    "op6_decontamination": decontaminate.SQL,
    "op11_fill_in_middle": fill_in_middle.SQL,
}
