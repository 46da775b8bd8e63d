"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from .chat import OP6_SQL, op6_query
from .collocations import OP12_SQL, op12_query
from .decontaminate import OP5_SQL, op5_query
from .minhash import op11_query
from .mixing import OP8_SQL, op8_query
from .secret_scan import op7_query
from .simhash import op4_query
from .spelling import op13_query
from .substring_dedup import op9_query
from .suffix_dedup import op10_query
from .topk import OP3_SQL, op3_query
from .toxicity import op1_query
from .url_filter import op2_query

QUERIES = {
    "op1_toxicity": op1_query,
    "op2_url_filter": op2_query,
    "op3_exact_topk": op3_query,
    "op4_simhash_neardup": op4_query,
    "op5_decontaminate": op5_query,
    "op6_chat_format": op6_query,
    "op7_secret_scan": op7_query,
    "op8_source_mix": op8_query,
    "op9_substring_dedup": op9_query,
    "op10_suffix_dedup": op10_query,
    "op11_minhash_neardup": op11_query,
    "op12_collocations": op12_query,
    "op13_spelling_variants": op13_query,
}

SQL = {"op5_decontaminate": OP5_SQL, "op3_exact_topk": OP3_SQL, "op6_chat_format": OP6_SQL, "op8_source_mix": OP8_SQL, "op12_collocations": OP12_SQL}
