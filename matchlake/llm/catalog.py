"""Queries of the text operators, and SQL for those that SQL can express."""

from matchlake.llm import (
    attention_lm,
    compression_quality,
    decontamination,
    fill_middle,
    filter_audit,
    jaccard_join,
    mixing,
    quality_rules,
    resharding,
    simhash,
    suffix_dedup,
    toxicity,
    url_rules,
)

QUERIES = {
    "op1_mixing": mixing.query,
    "op2_compression_quality": compression_quality.query,
    "op3_quality_rules": quality_rules.query,
    "op4_toxicity": toxicity.query,
    "op5_decontamination": decontamination.query,
    "op6_attention_lm": attention_lm.query,
    "op7_simhash": simhash.query,
    "op8_url_rules": url_rules.query,
    "op9_resharding": resharding.query,
    "op10_suffix_dedup": suffix_dedup.query,
    "op11_filter_audit": filter_audit.query,
    "op12_jaccard_join": jaccard_join.query,
    "op13_fill_middle": fill_middle.query,
}

ORACLES = {
    "op3_quality_rules": quality_rules.SQL,
    "op8_url_rules": url_rules.SQL,
    "op11_filter_audit": filter_audit.SQL,
    "op13_fill_middle": fill_middle.SQL,
}
