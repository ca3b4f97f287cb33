"""DataFrame → DataFrame operators (lazy; no collect on data, no Python UDF)."""

from verbatim.operators.audit import (catalog_audit, number_questions, question_dimension,
                                      question_index)
from verbatim.operators.bigrams import (bigram_occurrences, count_bigrams, remove_stop_pairs,
                                        sort_counts)
from verbatim.operators.broadcast import bounded_broadcast
from verbatim.operators.decode import decode_values, labels_table
from verbatim.operators.fill import fill_forward
from verbatim.operators.graph import BigramNetwork, bigram_network, edge_table, vertex_table
from verbatim.operators.harmonize import (fold_waves, hot_join_keys, natural_full_join,
                                          stack_waves, waves_disjoint)
from verbatim.operators.lookup import gazetteer_states, lookup_left, lookup_state
from verbatim.operators.reshape import select_prefix, unpivot_responses
from verbatim.operators.thresholds import (PercentileRule, percentile_cuts, settle_cuts,
                                           top_by_percentile)
from verbatim.operators.views import questions_matching, response_view

__all__ = [
    "BigramNetwork", "PercentileRule", "bigram_network", "bigram_occurrences",
    "bounded_broadcast", "catalog_audit", "count_bigrams", "decode_values", "edge_table",
    "fill_forward", "fold_waves", "gazetteer_states", "hot_join_keys", "labels_table",
    "lookup_left",
    "lookup_state", "natural_full_join", "number_questions", "percentile_cuts",
    "question_dimension", "question_index", "questions_matching", "remove_stop_pairs",
    "response_view", "select_prefix", "settle_cuts", "sort_counts",
    "stack_waves", "top_by_percentile",
    "unpivot_responses", "vertex_table", "waves_disjoint",
]
