"""The queries of this subpackage and their SQL."""

from .chat import op4_chat_format, op4_sql
from .decontaminate import op10_decontaminate, op10_sql
from .licenses import op5_license_scan
from .lm import op7_lm_scores
from .minhash import op1_minhash_near_dedup
from .pieces import op8_sentencepiece
from .quality import op3_quality_rules, op3_sql
from .secrets import op9_secret_scan
from .sharding import op2_sharding
from .urls import op6_sql, op6_url_filter

QUERIES = {f.__name__: f for f in (op1_minhash_near_dedup, op2_sharding, op3_quality_rules, op4_chat_format, op5_license_scan, op6_url_filter, op7_lm_scores, op8_sentencepiece, op9_secret_scan, op10_decontaminate)}
ORACLES = {"op3_quality_rules": op3_sql(), "op4_chat_format": op4_sql(), "op6_url_filter": op6_sql(), "op10_decontaminate": op10_sql()}
