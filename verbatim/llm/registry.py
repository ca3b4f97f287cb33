"""Queries of the training-data operators, by name, and their DuckDB SQL where there is any."""

from __future__ import annotations

from verbatim.llm.ann import op7_nearest
from verbatim.llm.bpe import op2_bpe
from verbatim.llm.cws import op8_fingerprints
from verbatim.llm.langid import op10_language_id
from verbatim.llm.lines import ORACLE as LINES_SQL
from verbatim.llm.lines import op9_line_dedup
from verbatim.llm.lm import op1_lm_score
from verbatim.llm.mixing import op5_mix_sources
from verbatim.llm.secrets import op4_secrets
from verbatim.llm.recompress import ORACLE as REPEATS_SQL
from verbatim.llm.recompress import op11_substring_dedup
from verbatim.llm.shards import op6_token_shards
from verbatim.llm.simhash import op3_simhash
from verbatim.llm.trie import ORACLE as TRIE_SQL
from verbatim.llm.trie import op12_prefix_trie
from verbatim.llm.variants import ORACLE as VARIANTS_SQL
from verbatim.llm.variants import op13_spelling_variants

QUERIES = {
    "op1_lm_score": op1_lm_score,
    "op2_bpe": op2_bpe,
    "op3_simhash": op3_simhash,
    "op4_secrets": op4_secrets,
    "op5_mix_sources": op5_mix_sources,
    "op6_token_shards": op6_token_shards,
    "op7_nearest": op7_nearest,
    "op8_fingerprints": op8_fingerprints,
    "op9_line_dedup": op9_line_dedup,
    "op10_language_id": op10_language_id,
    "op11_substring_dedup": op11_substring_dedup,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL = {
    "op9_line_dedup": LINES_SQL,
    "op11_substring_dedup": REPEATS_SQL,
    "op12_prefix_trie": TRIE_SQL,
    "op13_spelling_variants": VARIANTS_SQL,
}
