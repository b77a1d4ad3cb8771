"""Operators for training-data pipelines; nothing else in the library imports them."""

from __future__ import annotations

from .cap_filters import op10_cap_filters
from .chat_format import ORACLE as _CHAT_SQL
from .chat_format import op12_chat_format
from .filter_audit import ORACLE as _AUDIT_SQL
from .filter_audit import op11_filter_audit
from .importance_resampling import ORACLE as _RESAMPLING_SQL
from .importance_resampling import op13_importance_resampling
from .jaccard_groups import ORACLE as _JACCARD_SQL
from .jaccard_groups import op8_jaccard_groups
from .license_join import ORACLE as _LICENSE_SQL
from .license_join import op7_license_join
from .mixing import ORACLE as _MIXING_SQL
from .mixing import op5_mixing
from .packing import op1_packing
from .quality_fm import op6_quality_fm
from .quality_rules import op4_quality_rules
from .suffix_dedup import op2_suffix_dedup
from .token_counts import op3_token_counts
from .toxicity import op9_toxicity

QUERIES = {"op1_packing": op1_packing, "op2_suffix_dedup": op2_suffix_dedup, "op3_token_counts": op3_token_counts, "op4_quality_rules": op4_quality_rules, "op5_mixing": op5_mixing, "op6_quality_fm": op6_quality_fm, "op7_license_join": op7_license_join, "op8_jaccard_groups": op8_jaccard_groups, "op9_toxicity": op9_toxicity, "op10_cap_filters": op10_cap_filters, "op11_filter_audit": op11_filter_audit, "op12_chat_format": op12_chat_format, "op13_importance_resampling": op13_importance_resampling}
ORACLE = {"op5_mixing": _MIXING_SQL, "op7_license_join": _LICENSE_SQL, "op8_jaccard_groups": _JACCARD_SQL, "op11_filter_audit": _AUDIT_SQL, "op12_chat_format": _CHAT_SQL, "op13_importance_resampling": _RESAMPLING_SQL}
