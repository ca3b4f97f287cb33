"""Per-question percentile cut-off on bigram counts.

The cut is the exact percentile with linear interpolation between order statistics
(the textbook "type 7" rule, ``percentile`` in Spark, ``quantile_cont`` in SQL),
computed over the *distinct* bigrams of the question after stop-word removal.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PercentileRule:
    """Which percentile a question gets.

    Default reproduces the reference: a question code containing ``"1"`` uses the
    99th percentile, every other code the 95th.  ``marker=None`` gives every question
    ``low``.
    """

    marker: str | None = "1"
    high: float = 0.99
    low: float = 0.95

    def choose(self, question: Column, cuts: Column) -> Column:
        """``cuts`` is ``array(p_low, p_high)``."""
        if self.marker is None:
            return cuts[0]
        return F.when(question.contains(self.marker), cuts[1]).otherwise(cuts[0])


DEFAULT_RULE = PercentileRule()


def percentile_cuts(counts: DataFrame, rule: PercentileRule = DEFAULT_RULE,
                    value_col: str = "n", group_col: str = "question") -> DataFrame:
    """``(question, cut)``; both levels in one partial/final aggregation."""
    both = F.percentile(F.col(value_col), [rule.low, rule.high]).alias("__cuts")
    return (counts.groupBy(group_col).agg(both)
            .select(group_col, rule.choose(F.col(group_col), F.col("__cuts")).alias("cut")))


MAX_QUESTIONS = 100_000


def settle_cuts(cuts: DataFrame, max_rows: int = MAX_QUESTIONS) -> tuple[DataFrame, bool]:
    """Compute the cut table once; if it has at most ``max_rows`` rows (one per
    question), return it as a small local table that is safe to broadcast.

    Without this, the edge filter would start as a sort-merge join and shuffle the
    whole counts table by question before AQE could switch to a broadcast.
    """
    rows = cuts.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return cuts, False
    return cuts.sparkSession.createDataFrame(rows, cuts.schema), True


def top_by_percentile(counts: DataFrame, cuts: DataFrame, value_col: str = "n",
                      group_col: str = "question", broadcast_cuts: bool = False) -> DataFrame:
    """F8: keep rows with ``value >= cut`` (inclusive; a cut of 1.0 keeps everything).

    ``cuts`` has one row per question; ``broadcast_cuts`` only when its size is known
    to be bounded (a configured question list, or ``settle_cuts``).
    """
    side = F.broadcast(cuts) if broadcast_cuts else cuts
    return (counts.join(side, group_col)
            .where(F.col(value_col) >= F.col("cut"))
            .drop("cut"))
