"""The operators' queries, and their SQL where SQL can express them."""

from tidemark.llm import byte_bpe, chat, decontamination, drift_kmeans, exact_topk, line_dedup, mixing, ngram_join, quality_classifier, quality_rules, ranked_search, sharding, suffix_tree

QUERIES = {
    "op1_ngram_join": ngram_join.op1_ngram_join,
    "op2_sharding": sharding.op2_sharding,
    "op3_chat": chat.op3_chat,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op4_line_dedup_all_runs": line_dedup.op4_line_dedup_all_runs,
    "op5_quality_classifier": quality_classifier.op5_quality_classifier,
    "op6_quality_rules": quality_rules.op6_quality_rules,
    "op7_suffix_tree": suffix_tree.op7_suffix_tree,
    "op8_mixing": mixing.op8_mixing,
    "op9_exact_topk": exact_topk.op9_exact_topk,
    "op10_byte_bpe": byte_bpe.op10_byte_bpe,
    "op11_decontamination": decontamination.op11_decontamination,
    "op12_ranked_search": ranked_search.op12_ranked_search,
    "op13_centroid_clustering": drift_kmeans.op13_centroid_clustering,
}

ORACLE_SQL = {
    "op3_chat": chat.OP3_SQL,
    "op4_line_dedup": line_dedup.OP4_SQL,
    "op4_line_dedup_all_runs": line_dedup.OP4_SQL,
    "op8_mixing": mixing.OP8_SQL,
    "op9_exact_topk": exact_topk.OP9_SQL,
    "op11_decontamination": decontamination.OP11_SQL,
    "op12_ranked_search": ranked_search.OP12_SQL,
    "op13_centroid_clustering": drift_kmeans.OP13_SQL,
}
