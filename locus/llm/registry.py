"""The queries of this folder, by name, and the SQL that some of them equal."""

from locus.llm import chat, exact_dedup, jaccard_join, media, mixing, packing, quality, secrets, substring_dedup, suffix_model

QUERIES = {
    "op1_ngram_jaccard_join": jaccard_join.op1_ngram_jaccard_join,
    "op2_suffix_tree_scores": suffix_model.op2_suffix_tree_scores,
    "op3_quality_classifier": quality.op3_quality_classifier,
    "op4_substring_dedup": substring_dedup.op4_substring_dedup,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_chat_formatting": chat.op6_chat_formatting,
    "op7_media_columns": media.op7_media_columns,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_secret_scans": secrets.op9_secret_scans,
    "op10_mixing_sources": mixing.op10_mixing_sources,
}

SQL = {
    "op4_substring_dedup": substring_dedup.OP4_SQL,
    "op5_exact_dedup": exact_dedup.OP5_SQL,
}
