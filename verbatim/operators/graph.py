"""Directed word graph as two tables (G1, G2, A3) and the whole network (V2)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbatim.functions.text import tokens
from verbatim.operators.bigrams import bigram_occurrences, count_bigrams
from verbatim.session import cut_lineage
from verbatim.operators.thresholds import (DEFAULT_RULE, PercentileRule, percentile_cuts,
                                           settle_cuts, top_by_percentile)


class BigramNetwork(NamedTuple):
    counts: DataFrame
    cuts: DataFrame
    edges: DataFrame
    vertices: DataFrame


def edge_table(kept: DataFrame) -> DataFrame:
    """G1: ``(question, word1, word2, n)`` — word1 → word2, weight n."""
    return kept.select("question", "word1", "word2", "n")


def vertex_table(edges: DataFrame) -> DataFrame:
    """Distinct edge ends per question, ``(question, name)``."""
    ends = edges.select("question", F.explode(F.array("word1", "word2")).alias("name"))
    return ends.distinct()


def bigram_network(responses: DataFrame, question_col: str = "question",
                   response_col: str = "response",
                   stop: DataFrame | Sequence[str] | None = None,
                   rule: PercentileRule = DEFAULT_RULE,
                   questions: Sequence[str] | None = None,
                   materialize: bool = True, partitions: int | None = None,
                   tokenizer: Callable[[Column], Column] = tokens) -> BigramNetwork:
    """V2 for all questions at once (or only ``questions``).

    ``questions`` (a known, bounded list) both prunes the input — the predicate reaches
    the scan — and lets the cut table be broadcast.

    The counts feed two branches (the per-question cut and the edge filter).  With AQE
    on, Spark does not reuse the shared exchange between such branches, so the text
    would be tokenised and counted twice; ``materialize`` writes the counts once as a
    Parquet table in the shared checkpoint folder and both branches read it.
    """
    src = responses
    if questions is not None:
        src = src.where(F.col(question_col).isin(list(questions)))
    counts = count_bigrams(bigram_occurrences(src, question_col, response_col, stop=stop,
                                              partitions=partitions, tokenizer=tokenizer))
    if materialize:
        counts = cut_lineage(counts, "bigram-counts")
    return network_of_counts(counts, rule, bounded=questions is not None, settle=materialize)


def network_of_counts(counts: DataFrame, rule: PercentileRule = DEFAULT_RULE, bounded: bool = False,
                      settle: bool = True) -> BigramNetwork:
    """V2 from ``(question, word1, word2, n)``: exact cut, edges and vertices.

    ``bounded``: the questions are a known, short list; otherwise ``settle`` computes the cut
    table first to see its size."""
    cuts = percentile_cuts(counts, rule)
    if settle and not bounded:
        cuts, bounded = settle_cuts(cuts)
    edges = edge_table(top_by_percentile(counts, cuts, broadcast_cuts=bounded))
    return BigramNetwork(counts, cuts, edges, vertex_table(edges))
