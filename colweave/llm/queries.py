"""One query per operator, with production parameters over whole tables, and its SQL where SQL
can express it."""

from __future__ import annotations

from colweave.llm.decontaminate import op4_decontaminate
from colweave.llm.language_id import op8_language_id
from colweave.llm.lm_score import op5_lm_score
from colweave.llm.mixing import MIX_SQL, op3_mix_sources
from colweave.llm.near_dups import op7_near_duplicates
from colweave.llm.periodic_runs import op12_periodic_runs
from colweave.llm.prefix_trie import TRIE_SQL, op11_prefix_trie
from colweave.llm.quality_classifier import op6_quality_classifier
from colweave.llm.quality_rules import op10_quality_rules
from colweave.llm.suffix_dedup import op1_suffix_dedup
from colweave.llm.token_files import op9_token_files
from colweave.llm.toxicity import op13_toxicity
from colweave.llm.url_filter import op2_url_filter

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_mix_sources": op3_mix_sources,
    "op4_decontaminate": op4_decontaminate,
    "op5_lm_score": op5_lm_score,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_language_id": op8_language_id,
    "op9_token_files": op9_token_files,
    "op10_quality_rules": op10_quality_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_toxicity": op13_toxicity,
}
ORACLES: dict[str, str] = {"op3_mix_sources": MIX_SQL, "op11_prefix_trie": TRIE_SQL}
