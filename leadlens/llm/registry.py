"""Queries and DuckDB oracles of the training-data operators."""

from __future__ import annotations

from . import bpe, embedding_dedup, exact_dedup, hard_negatives, language_id, license_scan, line_dedup, ngram_join
from . import packing, quality_rules, substring_dedup, token_alignment, warc


def llm_queries() -> dict:
    return {
        "op1_paragraph_minhash": substring_dedup.op1_paragraph_minhash,
        "op2_ngram_jaccard_join": ngram_join.op2_ngram_jaccard_join,
        "op3_host_quality_rules": quality_rules.op3_host_quality_rules,
        "op4_license_scan": license_scan.op4_license_scan,
        "op5_bpe_automaton": bpe.op5_bpe_automaton,
        "op6_sum_of_squares_packing": packing.op6_sum_of_squares_packing,
        "op7_line_dedup": line_dedup.op7_line_dedup,
        "op8_hnsw_near_dedup": embedding_dedup.op8_hnsw_near_dedup,
        "op9_warc_transactions": warc.op9_warc_transactions,
        "op10_language_id": language_id.op10_language_id,
        "op11_token_alignment": token_alignment.op11_token_alignment,
        "op12_four_russians_negatives": hard_negatives.op12_four_russians_negatives,
        "op13_chunk_recipes": exact_dedup.op13_chunk_recipes,
    }


def llm_oracles() -> dict[str, str]:
    return {
        "op3_host_quality_rules": quality_rules.ORACLE,
        "op4_license_scan": license_scan.ORACLE,
        "op7_line_dedup": line_dedup.ORACLE,
        "op9_warc_transactions": warc.ORACLE,
        "op12_four_russians_negatives": hard_negatives.ORACLE,
        "op13_chunk_recipes": exact_dedup.ORACLE,
    }
