"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from meterline.llm import ann, chat, collocations, decontamination, fill_in_middle, language_model, mixing, ngram_join, packing, quality, secret_scan, substring, token_counts

QUERIES = {
    "op1_chat_format": chat.op1_chat_format,
    "op2_substring_dedup": substring.op2_substring_dedup,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_lm_scores": language_model.op4_lm_scores,
    "op5_pack_sequences": packing.op5_pack_sequences,
    "op6_nearest_neighbours": ann.op6_nearest_neighbours,
    "op7_secret_scan": secret_scan.op7_secret_scan,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_ngram_jaccard": ngram_join.op9_ngram_jaccard,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_decontaminate": decontamination.op11_decontaminate,
    "op12_collocations": collocations.op12_collocations,
    "op13_fill_in_middle": fill_in_middle.op13_fill_in_middle,
}
ORACLE_SQL = {
    "op1_chat_format": chat.OP1_SQL,
    "op2_substring_dedup": substring.OP2_SQL,
    "op8_mix_sources": mixing.OP8_SQL,
    "op9_ngram_jaccard": ngram_join.OP9_SQL,
    "op10_quality_rules": quality.OP10_SQL,
    "op11_decontaminate": decontamination.OP11_SQL,
    "op12_collocations": collocations.OP12_SQL,
    "op13_fill_in_middle": fill_in_middle.OP13_SQL,
}
