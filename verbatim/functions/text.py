"""T1 — the tokenizer contract, and n-gram pairing.

A token is a maximal run of letters, combining marks and digits in which

* an apostrophe (``'`` or ``’``) or a full stop may sit between two letters, and
* a full stop or a comma may sit between two digits.

So ``don't``, ``u.s``, ``3.5`` and ``1,000`` stay whole, ``co-pay`` and ``that.92``
split.  Text is lower-cased first.

Spark side: ``split`` on a *single-character* delimiter pattern (a character that is
neither a letter/mark/digit nor a joiner in a joining position), then drop the empty
strings.  The pattern never repeats a group, so Java's regex engine uses no recursion
and a token of any length (e.g. 8,000 characters of ``a1a1…``) is handled whole.

Oracle side (RE2, no look-around): ``regexp_extract_all`` with
``ORACLE_TOKEN_PATTERN`` gives the same token list.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token rule, stated once for each regex dialect.
TOKEN_DELIMITER = (
    r"(?=[^\p{L}\p{M}\p{N}])"
    r"(?!(?<=[\p{L}\p{M}])['’.](?=[\p{L}\p{M}]))"
    r"(?!(?<=\p{N})[.,](?=\p{N}))"
    r"[^\p{L}\p{M}\p{N}]"
)
ORACLE_TOKEN_PATTERN = (
    r"(?:[\p{L}\p{M}]+(?:['’.][\p{L}\p{M}]+)*|\p{N}+(?:[.,]\p{N}+)*)+"
)


def tokens(text: Column) -> Column:
    """array<string> of lower-cased tokens, in text order."""
    parts = F.split(F.lower(text), TOKEN_DELIMITER, -1)
    # array_remove, not a lambda filter: lambda variables defeat plan canonicalisation,
    # and with them the exchange reuse between the count and cut branches.
    return F.array_remove(parts, "")


def ngram_pairs(toks: Column, first: str = "word1", second: str = "word2") -> Column:
    """array<struct<word1, word2>> of adjacent tokens; fewer than two tokens → empty.

    ``greatest(size - 1, 0)`` keeps the slice length non-negative for empty arrays.
    """
    k = F.greatest(F.size(toks) - 1, F.lit(0))
    left = F.slice(toks, F.lit(1), k)
    right = F.slice(toks, F.lit(2), k)
    return F.arrays_zip(left.alias(first), right.alias(second))


def ngrams(toks: Column, n: int) -> Column:
    """array<string> of space-joined n-grams (general ``n``; ``n = 2`` gives bigrams)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    k = F.greatest(F.size(toks) - (n - 1), F.lit(0))
    starts = F.sequence(F.lit(1), k)
    return F.when(k > 0, F.transform(
        starts, lambda i: F.array_join(F.slice(toks, i, n), " "))).otherwise(
        F.array().cast("array<string>"))


def split_pair(bigram: Column) -> tuple[Column, Column]:
    """R3 standalone form: ``"word1 word2"`` → (word1, word2) on the first space."""
    parts = F.split(bigram, " ", 2)
    return parts[0].alias("word1"), F.get(parts, 1).alias("word2")
