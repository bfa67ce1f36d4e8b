"""The registered queries of this subpackage and the DuckDB twin of each one that SQL can express."""

from __future__ import annotations

from quantlake.llm import gam, jaccard, knn, linededup, manifest, merkle, mixing, packing, sharding, substring, toxicity, urlfilter, whiten

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_merkle_fingerprints": merkle.op2_merkle_fingerprints,
    "op3_sharding": sharding.op3_sharding,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_mixing": mixing.op5_mixing,
    "op6_url_filters": urlfilter.op6_url_filters,
    "op7_ngram_jaccard_join": jaccard.op7_ngram_jaccard_join,
    "op8_exact_topk_search": knn.op8_exact_topk_search,
    "op9_substring_dedup": substring.op9_substring_dedup,
    "op10_line_dedup": linededup.op10_line_dedup,
    "op11_merkle_manifest": manifest.op11_merkle_manifest,
    "op12_quality_classifier": gam.op12_quality_classifier,
    "op13_embedding_whitening": whiten.op13_embedding_whitening,
}

ORACLE_SQL = {
    "op2_merkle_fingerprints": merkle.ORACLE_SQL,
    "op6_url_filters": urlfilter.ORACLE_SQL,
    "op7_ngram_jaccard_join": jaccard.ORACLE_SQL,
    "op8_exact_topk_search": knn.ORACLE_SQL,
    "op9_substring_dedup": substring.ORACLE_SQL,
    "op10_line_dedup": linededup.ORACLE_SQL,
    "op11_merkle_manifest": manifest.ORACLE_SQL,
}
