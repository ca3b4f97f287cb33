"""Entries 2 and 3 for all questions of a panel in one job each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatim.functions.keys import page_title
from verbatim.operators.audit import MAX_VARIABLES, question_dimension
from verbatim.operators.broadcast import bounded_broadcast
from verbatim.operators.graph import BigramNetwork, bigram_network
from verbatim.operators.thresholds import DEFAULT_RULE, PercentileRule
from verbatim.plans.panels import PanelConfig


def panel_questions(spark: SparkSession, cfg: PanelConfig,
                    texts: DataFrame | dict | None = None) -> DataFrame:
    return question_dimension(spark, cfg.name, list(cfg.question_codes), texts)


def panel_network(long: DataFrame, cfg: PanelConfig, stop=None,
                  rule: PercentileRule = DEFAULT_RULE) -> BigramNetwork:
    """Bigram network of every configured question (bounded list → broadcast cuts)."""
    return bigram_network(long, stop=stop, rule=rule, questions=list(cfg.question_codes))


def attach_questions(df: DataFrame, questions: DataFrame) -> DataFrame:
    """Add ``panel, question_num, question_text, title`` by code.

    A code outside the list is an error of the caller's question list, so its rows are kept
    with NULLs rather than lost.  Broadcast only behind a size check.
    """
    text = F.col("text") if "text" in questions.columns else F.lit(None).cast("string")
    dim = questions.select("panel", F.col("code").alias("question"),
                           F.col("num").alias("question_num"),
                           F.coalesce(text, F.col("code")).alias("question_text"),
                           page_title(F.col("num")).alias("title"))
    return df.join(bounded_broadcast(dim, MAX_VARIABLES), "question", "left")


def responses_by_question(long: DataFrame, questions: DataFrame,
                          drop: Sequence[str] = ()) -> DataFrame:
    """Entry 3 for all questions: the long table keyed for partitioned output."""
    return attach_questions(long.drop(*drop), questions)
