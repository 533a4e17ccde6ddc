"""Registry of this subpackage: query name -> (spark, sf_dir) -> DataFrame, and DuckDB SQL."""

from __future__ import annotations

from strataloom.llm import chat_format, conversation_trie, decontaminate, html_mincut, importance_resampling, line_dedup, ngram_join, source_mixing, spotsigs, token_rollup, toxicity_knn, warc_chunks

QUERIES = {
    "op1_importance_resampling": importance_resampling.op1_importance_resampling,
    "op2_spot_fingerprints": spotsigs.op2_spot_fingerprints,
    "op3_ngram_join": ngram_join.op3_ngram_join,
    "op4_mix_sources": source_mixing.op4_mix_sources,
    "op5_extract_text": html_mincut.op5_extract_text,
    "op6_token_counts": token_rollup.op6_token_counts,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_chat_format": chat_format.op8_chat_format,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_toxicity": toxicity_knn.op10_toxicity,
    "op11_conversation_trie": conversation_trie.op11_conversation_trie,
    "op12_warc": warc_chunks.op12_warc,
}

ORACLE_SQL = {
    "op3_ngram_join": ngram_join.OP3_SQL,
    "op4_mix_sources": source_mixing.OP4_SQL,
    "op7_line_dedup": line_dedup.OP7_SQL,
    "op9_decontaminate": decontaminate.OP9_SQL,
    "op11_conversation_trie": conversation_trie.OP11_SQL,
    "op12_warc": warc_chunks.OP12_SQL,
}
