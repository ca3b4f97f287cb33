"""A1/A2 — bigram counts kept per wave and merged, so that a new wave costs its own texts only.

Counts add up: the counts of all waves are the sum of each wave's, and what a corrected wave
changes is its new counts less its old ones.  Two published tables (``plans.publish``) hold
them:

* ``wave`` — each wave's own counts, ``(question, word1, word2, n)``;
* ``merged`` — their sum, from which the network is made: the cut is a percentile over
  the merged counts, so it is exact, not an estimate put together from the waves' cuts.

Adding, replacing or removing a wave reads that wave's texts, its old counts and the
merged table, and publishes both tables at one moment.  Two changes at once can't lose one:
the manifest is claimed for the number after the one that was read, otherwise the merge is made
again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbatim.operators.bigrams import bigram_occurrences, count_bigrams
from verbatim.operators.graph import BigramNetwork, network_of_counts
from verbatim.operators.thresholds import DEFAULT_RULE, PercentileRule
from verbatim.plans.publish import ATTEMPTS, Published, Refresh

MERGED = "all"
COLUMNS = ("question", "word1", "word2", "n")


class WaveCounts:
    """The counts under one root folder; ``stop`` and the tokenizer must be the same for all waves."""

    def __init__(self, spark: SparkSession, root: str, stop: DataFrame | Sequence[str] | None = None):
        self.spark, self.stop, self.pages = spark, stop, Published(spark, root)

    def waves(self) -> list[str]:
        return self.pages.panels("wave")

    def add(self, wave: str, responses: DataFrame, question_col: str = "question", response_col: str = "response",
            partitions: int | None = None) -> None:
        """Count a wave's responses, in place of what it had before."""
        counts = count_bigrams(bigram_occurrences(responses, question_col, response_col, stop=self.stop, partitions=partitions))
        new = Refresh(self.pages, wave)
        new.write("wave", counts.select(*COLUMNS))
        self._change(wave, new)

    def remove(self, wave: str) -> None:
        if wave not in self.waves():
            raise LookupError(f"no wave {wave!r}")
        self._change(wave, None)

    def _change(self, wave: str, new: Refresh | None) -> None:
        for _ in range(ATTEMPTS):
            now = self.pages.manifest()
            old, merged = now["tables"].get("wave", {}).get(wave), now["tables"].get("merged", {}).get(MERGED)
            parts = [self.pages._read(merged)] if merged else []
            if old:
                parts.append(self.pages._read(old).withColumn("n", -F.col("n")))
            if new:
                parts.append(new.read("wave"))
            total = reduce(DataFrame.unionByName, parts).groupBy("question", "word1", "word2").agg(F.sum("n").alias("n")).where("n <> 0")
            both = Refresh(self.pages, MERGED)
            both.write("merged", total.select(*COLUMNS))
            if self.pages.publish({wave: new.tables if new else {}, MERGED: both.tables}, expected=now["number"]):
                return
        raise RuntimeError(f"{self.pages.root}: {ATTEMPTS} other changes were published at the same time")

    def counts(self) -> DataFrame:
        """The merged counts, as last published."""
        return self.pages.table("merged", MERGED).select(*COLUMNS)

    def network(self, rule: PercentileRule = DEFAULT_RULE, questions: Sequence[str] | None = None) -> BigramNetwork:
        """The network of all waves together; no text is read."""
        counts = self.counts()
        if questions is not None:
            counts = counts.where(F.col("question").isin(list(questions)))
        return network_of_counts(counts, rule, bounded=questions is not None)
