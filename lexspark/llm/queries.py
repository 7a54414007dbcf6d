"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from .conversation_repair import op13_conversation_repair
from .decontaminate import op4_decontaminate
from .fingerprint import op3_fingerprint
from .jaccard_join import op2_jaccard_join
from .lm_score import op9_lm_score
from .merkle import ORACLE as MERKLE_SQL
from .merkle import op11_merkle
from .mixing import ORACLE as MIXING_SQL
from .mixing import op12_mixing
from .pii import op6_pii
from .sentencepiece import op1_sentencepiece
from .substring_dedup import op7_substring_dedup
from .suffix_dedup import op5_suffix_dedup
from .toxicity import op8_toxicity
from .url_filter import ORACLE as URL_SQL
from .url_filter import op10_url_filter

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_fingerprint": op3_fingerprint,
    "op4_decontaminate": op4_decontaminate,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_pii": op6_pii,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_lm_score": op9_lm_score,
    "op10_url_filter": op10_url_filter,
    "op11_merkle": op11_merkle,
    "op12_mixing": op12_mixing,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL = {
    "op10_url_filter": URL_SQL,
    "op11_merkle": MERKLE_SQL,
    "op12_mixing": MIXING_SQL,
}
