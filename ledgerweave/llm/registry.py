"""Queries of the training-data operators and their DuckDB texts (where SQL can express them)."""

from __future__ import annotations

from ledgerweave.llm import best_fit_packing, chat_format, collocations, exact_topk, hard_negatives, jaccard_join, learned_partitions, ngram_lm, piece_codec, source_mix, suffix_dedup, token_counts, toxicity

QUERIES = {
    "op1_learned_partitions": learned_partitions.op1_learned_partitions,
    "op2_chat_format": chat_format.op2_chat_format,
    "op3_piece_codec": piece_codec.op3_piece_codec,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_ngram_lm": ngram_lm.op5_ngram_lm,
    "op6_source_mix": source_mix.op6_source_mix,
    "op7_exact_topk": exact_topk.op7_exact_topk,
    "op8_suffix_array_dedup": suffix_dedup.op8_suffix_array_dedup,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_ngram_jaccard_join": jaccard_join.op10_ngram_jaccard_join,
    "op11_best_fit_packing": best_fit_packing.op11_best_fit_packing,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_collocations": collocations.op13_collocations,
}

ORACLE = {
    "op2_chat_format": chat_format.OP2_SQL,
    "op7_exact_topk": exact_topk.OP7_SQL,
    "op12_hard_negatives": hard_negatives.OP12_SQL,
    "op13_collocations": collocations.OP13_SQL,
}
