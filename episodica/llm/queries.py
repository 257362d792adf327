"""Queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .cover_trees import ORACLE as NEAR_VECTORS_SQL
from .cover_trees import op13_near_vectors
from .decontaminate import op3_decontaminate
from .lexical_search import ORACLE as RANKED_SQL
from .lexical_search import op12_ranked_search
from .mixing import op9_mixing
from .ngram_join import op5_ngram_join
from .personal_data import op4_personal_data
from .prefix_trie import ORACLE as TRIE_SQL
from .prefix_trie import op11_prefix_trie
from .quality import op2_quality
from .repeats import op1_repeats
from .search import ORACLE as TOP_K_SQL
from .search import op7_top_k
from .secret_scan import op6_secrets
from .token_counts import op8_token_counts
from .url_lists import ORACLE as URL_LISTS_SQL
from .url_lists import op10_url_lists

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeats": op1_repeats,
    "op2_quality": op2_quality,
    "op3_decontaminate": op3_decontaminate,
    "op4_personal_data": op4_personal_data,
    "op5_ngram_join": op5_ngram_join,
    "op6_secrets": op6_secrets,
    "op7_top_k": op7_top_k,
    "op8_token_counts": op8_token_counts,
    "op9_mixing": op9_mixing,
    "op10_url_lists": op10_url_lists,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_ranked_search": op12_ranked_search,
    "op13_near_vectors": op13_near_vectors,
}

ORACLES: dict[str, str] = {"op7_top_k": TOP_K_SQL, "op10_url_lists": URL_LISTS_SQL, "op11_prefix_trie": TRIE_SQL, "op12_ranked_search": RANKED_SQL, "op13_near_vectors": NEAR_VECTORS_SQL}
