"""Queries of the subpackage and, where SQL can express them, their checks."""

from __future__ import annotations

import corpus_pipeline

from . import bpe, decontamination, html_text, merkle, mixing, pii, quality_classifier, quality_rules, sharding, simhash, suffix_dedup, token_alignment, topk

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op5_bucket_refined_repeats": suffix_dedup.op5_bucket_refined_repeats,
    "op4_subword_quality": quality_classifier.op4_subword_quality,
    "op3_page_differencing": html_text.op3_page_differencing,
    "op8_tiled_top_k": topk.op8_tiled_top_k,
    "op2_feistel_shards": sharding.op2_feistel_shards,
    "op1_soft_mixture": mixing.op1_soft_mixture,
    "op6_information_sanitised": pii.op6_information_sanitised,
    "op7_host_quality_rules": quality_rules.op7_host_quality_rules,
    "op9_simhash_components": simhash.op9_simhash_components,
    "op10_bpe_tree": bpe.op10_bpe_tree,
    "op11_aho_corasick_hits": decontamination.op11_aho_corasick_hits,
    "op12_incremental_witnesses": merkle.op12_incremental_witnesses,
    "op13_spill_counts": token_alignment.op13_spill_counts,
}
ORACLES: dict[str, str] = {
    **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}),
    "op8_tiled_top_k": topk.OP8_SQL,
    "op11_aho_corasick_hits": decontamination.OP11_SQL,
    "op12_incremental_witnesses": merkle.OP12_SQL,
}
