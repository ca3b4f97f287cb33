"""K1/K2 — one write per result table, partitioned by panel and question number.

Instead of one rendered page per question, every question's rows land in their own
``panel=…/question_num=…`` folder in a single job; reading one page's data is a
partition-pruned scan.  Each panel's folder is overwritten as a whole and on its own: both
panels live side by side, and a question that left a panel's list leaves no folder behind.
Rows of codes outside the question list have no page and are not written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbatim.operators.graph import BigramNetwork
from verbatim.plans.reports import attach_questions


def panels_of(questions: DataFrame) -> list[str]:
    """The panels of a (configured) question list."""
    return [r[0] for r in questions.select("panel").distinct().collect()]


def write_partitioned(df: DataFrame, path: str, panels: list[str], mode: str = "overwrite") -> None:
    """``rebalance`` groups rows by output folder but lets AQE split a hot question
    over several writers (and merge small ones), so one busy question is not one task."""
    for panel in panels:
        rows = df.where(F.col("panel") == panel).drop("panel")
        (rows.hint("rebalance", "question_num").write.mode(mode)
             .partitionBy("question_num").parquet(f"{path}/panel={panel}"))


def write_by_panel(df: DataFrame, path: str, panels: list[str]) -> None:
    """A small table (question index, catalog audit): replaces its panels' folders only."""
    for panel in panels:
        (df.where(F.col("panel") == panel).drop("panel")
           .write.mode("overwrite").parquet(f"{path}/panel={panel}"))


def write_network(net: BigramNetwork, questions: DataFrame, path: str,
                  mode: str = "overwrite") -> None:
    panels = panels_of(questions)
    write_partitioned(attach_questions(net.edges, questions), f"{path}/edges", panels, mode)
    write_partitioned(attach_questions(net.vertices, questions), f"{path}/vertices", panels, mode)


def write_responses(long: DataFrame, questions: DataFrame, path: str,
                    mode: str = "overwrite") -> None:
    write_partitioned(attach_questions(long, questions), f"{path}/responses",
                      panels_of(questions), mode)
