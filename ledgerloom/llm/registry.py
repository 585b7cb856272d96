"""The corpus operators' queries and the SQL that states their results."""

from __future__ import annotations

import corpus_pipeline

from . import embedding_dedup, exact_dedup, hard_negatives, language_id, license_scan, mixing, packing, quality_classifier, sharding, simhash_dedup, spelling_variants, substring_dedup, suffix_dedup

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_language_id": language_id.op1_language_id,
    "op2_license_scan": license_scan.op2_license_scan,
    "op3_mixing": mixing.op3_mixing,
    "op4_embedding_dedup": embedding_dedup.op4_embedding_dedup,
    "op5_sharding": sharding.op5_sharding,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_packing": packing.op7_packing,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_simhash_dedup": simhash_dedup.op10_simhash_dedup,
    "op11_spelling_variants": spelling_variants.op11_spelling_variants,
    "op12_quality_classifier": quality_classifier.op12_quality_classifier,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

ORACLE_SQL = {
    "op2_license_scan": license_scan.ORACLE,
    "op4_embedding_dedup": embedding_dedup.ORACLE,
    "op5_sharding": sharding.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op9_substring_dedup": substring_dedup.ORACLE,
    "op11_spelling_variants": spelling_variants.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}

if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
