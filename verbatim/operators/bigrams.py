"""Bigram network for every question in one distributed pass.

tokenise → adjacent pairs (before stop-word removal) → drop pairs with a stop word
on either side → count per (question, word1, word2).

Plan: Scan → Project(tokens) → Generate(inline) → Filter(NOT word IN stop set) → partial
HashAggregate, all in one stage; one Exchange on (question, word1, word2)
→ final HashAggregate.  Map-side partial aggregation bounds what a hot bigram or a hot
question sends to a single reducer by the number of map tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbatim.functions.text import ngram_pairs, tokens
from verbatim.operators.broadcast import bounded_broadcast
from verbatim.sources.stopwords import ENGLISH_STOP_WORDS, MAX_BROADCAST_WORDS, stop_words


MAX_LITERAL_WORDS = 10_000  # a longer list is joined as a table


def remove_stop_pairs(pairs: DataFrame, stop: DataFrame | Sequence[str] | None = None,
                      by: Sequence[str] = ()) -> DataFrame:
    """Drop a pair when either word is a stop word; words are never NULL.

    A fixed word list becomes a hashed ``NOT IN`` predicate (``InSet``) inside the
    generated code of the scan stage; a stop-word *table* is joined with two
    broadcast left-anti joins behind a row-count check.  ``by`` keys the table, e.g.
    ``["lang"]`` with a ``(lang, word)`` table applies each language's own list.
    """
    if by:
        return _remove_keyed(pairs, stop, list(by))
    if stop is None or not isinstance(stop, DataFrame):
        words = sorted({w.lower() for w in (ENGLISH_STOP_WORDS if stop is None else stop)})
        if len(words) <= MAX_LITERAL_WORDS:
            out = pairs.where(~F.col("word1").isin(words) & ~F.col("word2").isin(words))
            return out.where(F.col("word1").isNotNull() & F.col("word2").isNotNull())
        stop = stop_words(pairs.sparkSession, words)
    sw = bounded_broadcast(stop_words(pairs.sparkSession, stop), MAX_BROADCAST_WORDS)
    s1 = sw.select(F.col("word").alias("__sw1"))
    s2 = sw.select(F.col("word").alias("__sw2"))
    out = pairs.join(s1, F.col("word1") == F.col("__sw1"), "left_anti")
    out = out.join(s2, F.col("word2") == F.col("__sw2"), "left_anti")
    return out.where(F.col("word1").isNotNull() & F.col("word2").isNotNull())


def _remove_keyed(pairs: DataFrame, stop: DataFrame, by: list[str]) -> DataFrame:
    sw = stop.select(*[F.col(b) for b in by], F.lower(F.col("word")).alias("word")).dropna(
        subset=["word"]).distinct()
    sw = bounded_broadcast(sw, MAX_BROADCAST_WORDS)
    out = pairs
    for i, w in enumerate(("word1", "word2")):
        side = sw.select(*[F.col(b).alias(f"__sk{i}_{b}") for b in by], F.col("word").alias(f"__sw{i}"))
        cond = (F.col(w) == F.col(f"__sw{i}"))
        for b in by:
            cond = cond & F.col(b).eqNullSafe(F.col(f"__sk{i}_{b}"))
        out = out.join(side, cond, "left_anti")
    return out.where(F.col("word1").isNotNull() & F.col("word2").isNotNull())


def bigram_occurrences(responses: DataFrame, question_col: str = "question",
                       response_col: str = "response", keep: Sequence[str] = (),
                       stop: DataFrame | Sequence[str] | None = None,
                       stop_by: Sequence[str] = (), partitions: int | None = None,
                       tokenizer: Callable[[Column], Column] = tokens) -> DataFrame:
    """One row per adjacent word pair occurrence: ``keep..., question, word1, word2``.

    ``tokenizer`` gives a text's words: ``functions.text.tokens``, or ``functions.words.unicode_words``
    for underscores, colons and scripts without spaces by the Unicode rules.

    Tokenising is the costly step and runs where the input's rows are: a large input has
    many splits.  ``partitions`` deals the responses out first, for an input of few splits
    (one small file); only the columns used are moved.

    Responses that are NULL or ``""`` are skipped; responses with fewer than two
    tokens yield nothing.  Pairs never span two responses.
    """
    src = responses.where(F.col(response_col) != "").select(*dict.fromkeys([*keep, question_col, response_col]))
    if partitions:
        src = src.repartition(partitions)
    # Tokens are projected once and referenced by name: pairing reads the array four
    # times (two slices, two sizes), and the tokenizer must not run four times.
    toks = src.select(*[F.col(k) for k in keep], F.col(question_col).alias("question"),
                      tokenizer(F.col(response_col)).alias("__tokens"))
    pairs = toks.select(*[F.col(k) for k in keep], "question",
                        F.inline(ngram_pairs(F.col("__tokens"))))
    return remove_stop_pairs(pairs, stop, by=stop_by)


def count_bigrams(occurrences: DataFrame) -> DataFrame:
    """A1: ``(question, word1, word2, n)``."""
    return occurrences.groupBy("question", "word1", "word2").agg(F.count(F.lit(1)).alias("n"))


def sort_counts(counts: DataFrame) -> DataFrame:
    """O2: descending ``n``, ties by words (for output only; the network never sorts)."""
    return counts.orderBy(F.desc("n"), "question", "word1", "word2")
