"""The corpus queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, lexical_search, merkle_manifest
from tidemark.llm.context_tree import op3_context_tree
from tidemark.llm.exact_dedup import op10_exact_dedup
from tidemark.llm.language_id import op2_language_id
from tidemark.llm.lexical_search import op11_lexical_search
from tidemark.llm.merkle_manifest import op13_merkle_manifest
from tidemark.llm.near_dedup import op7_minhash_dedup
from tidemark.llm.packing import op4_best_fit_packing
from tidemark.llm.phrase_fingerprint import op8_phrase_fingerprint
from tidemark.llm.quality_fm import op6_quality_fm
from tidemark.llm.sentence_pieces import op5_sentencepiece
from tidemark.llm.token_files import op9_token_files
from tidemark.llm.vector_graph import op12_vector_graph
from tidemark.llm.wrappers import op1_main_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_main_text": op1_main_text,
    "op2_language_id": op2_language_id,
    "op3_context_tree": op3_context_tree,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_quality_fm": op6_quality_fm,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_phrase_fingerprint": op8_phrase_fingerprint,
    "op9_token_files": op9_token_files,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_vector_graph": op12_vector_graph,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE: dict[str, str] = {
    "op10_exact_dedup": exact_dedup.SQL,
    "op11_lexical_search": lexical_search.SQL,
    "op13_merkle_manifest": merkle_manifest.SQL,
}
