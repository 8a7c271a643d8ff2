"""The registered queries of this package, and their SQL where SQL can express them."""
from __future__ import annotations

from sonora.llm.jaccard_join import op11_jaccard_join
from sonora.llm.language_id import op4_language_id
from sonora.llm.mixing import op5_mixing
from sonora.llm.oracles import ORACLES  # noqa: F401
from sonora.llm.packing import op9_packing
from sonora.llm.quality_classifier import op10_quality_classifier
from sonora.llm.quality_rules import op1_quality_rules
from sonora.llm.secret_scan import op2_secret_scan
from sonora.llm.simhash_dedup import op7_simhash_dedup
from sonora.llm.spelling_variants import op12_spelling_variants
from sonora.llm.substring_dedup import op6_substring_dedup
from sonora.llm.target_resampling import op13_target_resampling
from sonora.llm.token_counts import op8_token_counts
from sonora.llm.topk_search import op3_topk_search

QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_secret_scan": op2_secret_scan,
    "op3_topk_search": op3_topk_search,
    "op4_language_id": op4_language_id,
    "op5_mixing": op5_mixing,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_packing": op9_packing,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_target_resampling": op13_target_resampling,
}


