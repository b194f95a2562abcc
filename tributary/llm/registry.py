"""Registered corpus queries and their DuckDB SQL where it can express them."""

from __future__ import annotations

from tributary.llm import exact_dedup, language_id, license_scan, line_dedup, lm_scoring, quality_rules
from tributary.llm import sequence_packing, simhash_dedup, source_divergence, source_mixing, spelling_variants
from tributary.llm import vector_search, warc

QUERIES = {f.__name__: f for f in (
    warc.op1_warc, source_mixing.op2_source_mixing, sequence_packing.op3_sequence_packing,
    vector_search.op4_vector_search, language_id.op5_language_id, quality_rules.op6_quality_rules,
    lm_scoring.op7_lm_scoring, simhash_dedup.op8_simhash_dedup,
    line_dedup.op9_line_dedup, license_scan.op10_license_scan,
    source_divergence.op11_source_divergence, spelling_variants.op12_spelling_variants,
    exact_dedup.op13_exact_dedup,
)}


def oracle_sql() -> dict[str, str]:
    return {"op1_warc": warc.SQL, "op6_quality_rules": quality_rules.SQL,
            "op9_line_dedup": line_dedup.SQL, "op10_license_scan": license_scan.sql(),
            "op11_source_divergence": source_divergence.SQL, "op13_exact_dedup": exact_dedup.SQL}
