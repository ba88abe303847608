"""Queries of the corpus operators."""

from __future__ import annotations

from . import decontamination, expressible, lm_score, near_dedup, piece_sampling, pii, quality_net, quality_rules, range_coder, sharding, token_counts

QUERIES = {
    f.__name__: f
    for f in (
        decontamination.op1_seed_align, token_counts.op2_separator_scan, quality_rules.op3_ngram_llr, range_coder.op4_context_range_coder,
        near_dedup.op5_dart_minhash, pii.op6_disclosure, piece_sampling.op7_gumbel_top_k, sharding.op8_jump_shards,
        quality_net.op9_byte_cnn, lm_score.op10_kneser_ney,
    )
} | expressible.QUERIES

ORACLE: dict[str, str] = expressible.ORACLE
