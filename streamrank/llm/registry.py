"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from .decontamination import op9_decontaminate
from .html_text import op4_html
from .importance_resampling import op13_resample
from .language_id import op10_language
from .quality_classifier import op7_quality
from .secret_scan import op12_secrets
from .simhash_dedup import op1_simhash
from .source_mixing import OP2_SQL, op2_mix
from .substring_dedup import op6_substrings
from .token_alignment import op11_align
from .token_output import op5_token_ids
from .token_rollups import op8_token_counts
from .vector_search import op3_neighbours

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_mix": op2_mix,
    "op3_neighbours": op3_neighbours,
    "op4_html": op4_html,
    "op5_token_ids": op5_token_ids,
    "op6_substrings": op6_substrings,
    "op7_quality": op7_quality,
    "op8_token_counts": op8_token_counts,
    "op9_decontaminate": op9_decontaminate,
    "op10_language": op10_language,
    "op11_align": op11_align,
    "op12_secrets": op12_secrets,
    "op13_resample": op13_resample,
}

ORACLES = {
    "op2_mix": OP2_SQL,
}
