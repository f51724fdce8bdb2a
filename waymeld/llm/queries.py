"""Queries of this subpackage and their SQL twins."""

from . import decontaminate, deleted_interpolation, exact_dedup, jaccard_join, language_id, passage_chains, preference_chat, quality_cnn, source_mix, toxicity

QUERIES = {
    "op1_passage_chains": passage_chains.op1_passage_chains,
    "op5_deleted_interpolation": deleted_interpolation.op5_deleted_interpolation,
    "op9_quality_cnn": quality_cnn.op9_quality_cnn,
    "op10_language": language_id.op10_language,
    "op4_jaccard_groups": jaccard_join.op4_jaccard_groups,
    "op2_source_mix": source_mix.op2_source_mix,
    "op3_toxicity": toxicity.op3_toxicity,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_template_leaks": decontaminate.op7_template_leaks,
    "op8_preference_chat": preference_chat.op8_preference_chat,
}
ORACLE = {"op4_jaccard_groups": jaccard_join.SQL, "op6_exact_dedup": exact_dedup.SQL, "op8_preference_chat": preference_chat.SQL}
