"""The queries of this package and the SQL they must agree with, where SQL can express them."""

from __future__ import annotations

from folioflow.llm.decontaminate import op8_benchmark_decontamination
from folioflow.llm.exact_topk import OP1_SQL, op1_exact_topk
from folioflow.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from folioflow.llm.html_text import op6_html_text
from folioflow.llm.language_id import op10_language_id
from folioflow.llm.lexical_search import OP13_SQL, op13_lexical_search
from folioflow.llm.line_dedup import op7_line_dedup
from folioflow.llm.merge_dropout import op3_merge_dropout
from folioflow.llm.minhash_dedup import op12_minhash_dedup
from folioflow.llm.ngram_join import op5_ngram_jaccard_join
from folioflow.llm.sharding import op9_hash_tree_sharding, op9_sql
from folioflow.llm.suffix_dedup import op4_suffix_dedup
from folioflow.llm.token_files import op2_token_arrow_files

QUERIES = {
    "op1_exact_topk": op1_exact_topk,
    "op2_token_arrow_files": op2_token_arrow_files,
    "op3_merge_dropout": op3_merge_dropout,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_html_text": op6_html_text,
    "op7_line_dedup": op7_line_dedup,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_hash_tree_sharding": op9_hash_tree_sharding,
    "op10_language_id": op10_language_id,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_minhash_dedup": op12_minhash_dedup,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL = {
    "op1_exact_topk": OP1_SQL,
    "op9_hash_tree_sharding": op9_sql(),
    "op11_hard_negatives": OP11_SQL,
    "op13_lexical_search": OP13_SQL,
}
