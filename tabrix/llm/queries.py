"""The registered queries of this package, one per operator, and the pipeline."""

from __future__ import annotations

from tabrix.llm.q_arc import OP10_SQL, op10_arc_to_warc
from tabrix.llm.q_chat import OP2_SQL, op2_chat_formatting
from tabrix.llm.q_collocations import OP12_SQL, op12_hat_trie_collocations
from tabrix.llm.q_decontaminate import OP4_SQL, op4_fm_index_decontamination
from tabrix.llm.q_katz import op8_katz_backoff_scores
from tabrix.llm.q_packing import op1_best_fit_packing
from tabrix.llm.q_quality import OP9_SQL, op9_risk_controlled_quality
from tabrix.llm.q_rollup import op6_token_rollup
from tabrix.llm.q_setsketch import OP5_SQL, op5_setsketch_near_dedup
from tabrix.llm.q_sharding import op7_hash_tree_sharding
from tabrix.llm.q_substrings import op3_suffix_array_dedup
from tabrix.llm.q_urls import OP13_SQL, op13_link_graph_url_filter
from tabrix.llm.q_whitening import op11_multiplicity_whitening

QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing,
    op2_chat_formatting,
    op3_suffix_array_dedup,
    op4_fm_index_decontamination,
    op5_setsketch_near_dedup,
    op6_token_rollup,
    op7_hash_tree_sharding,
    op8_katz_backoff_scores,
    op9_risk_controlled_quality,
    op10_arc_to_warc,
    op11_multiplicity_whitening,
    op12_hat_trie_collocations,
    op13_link_graph_url_filter,
)}
ORACLE_SQL: dict[str, str] = {
    "op2_chat_formatting": OP2_SQL,
    "op4_fm_index_decontamination": OP4_SQL,
    "op5_setsketch_near_dedup": OP5_SQL,
    "op9_risk_controlled_quality": OP9_SQL,
    "op10_arc_to_warc": OP10_SQL,
    "op12_hat_trie_collocations": OP12_SQL,
    "op13_link_graph_url_filter": OP13_SQL,
}
