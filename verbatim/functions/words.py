"""T1/X12 — words by the Unicode word-break rules (UAX #29), as built-in expressions.

``tokens`` (``functions.text``) approximates them for letters and digits.  Here the rules are
followed as they are written:

* WB5-WB10: letters and digits run on; ``. ' ’ ‘ : ·`` and their like join letters, ``. , ;`` and
  theirs digits; Hebrew letters keep a single quote and join over a double one;
* WB13: Katakana runs on, but not into letters or digits; WB13a, WB13b: underscores and other
  connectors join all of these, also at either end (``snake_case``, ``_x``);
* Han and Hiragana characters, and the scripts written without spaces for which the rules know
  no words (Thai, Lao, Khmer, Myanmar), are a word each: a dictionary would be needed to do
  better;
* WB4: combining marks, format characters and joiners belong to the character before them.

A word holds a letter, digit, Katakana or one of these characters; anything else is no word.

The text is split at single characters and at places between two characters, each decided by a
look at a few neighbours, so the time is linear however long a run is.  (``sentences`` also
splits words, but by the JVM's older rules and with sentence breaks that drop text.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Character classes of the rules, in Java's notation.
ALONE = r"\p{IsHan}\p{IsHiragana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
KATAKANA = r"\p{IsKatakana}\x{30FC}\x{FF70}\x{3031}-\x{3035}\x{309B}\x{309C}\x{30A0}"
LETTER = rf"\p{{IsAlphabetic}}&&[^{ALONE}{KATAKANA}\p{{M}}\p{{Nd}}]"
DIGIT = r"\p{Nd}"
CONNECTOR = r"\p{Pc}\x{202F}"
ATTACHED = r"\p{M}\p{Cf}"
MID_LETTER = r":\x{B7}\x{387}\x{55F}\x{5F4}\x{2027}\x{FE13}\x{FE55}\x{FF1A}"
MID_BOTH = r".'\x{2018}\x{2019}\x{2024}\x{FE52}\x{FF07}\x{FF0E}"
MID_DIGIT = r",;\x{37E}\x{589}\x{60C}\x{60D}\x{66C}\x{7F8}\x{2044}\x{FE10}\x{FE14}\x{FE50}\x{FE54}\x{FF0C}\x{FF1B}"
HEBREW = r"\p{IsHebrew}&&\p{L}"

_A = f"[{ATTACHED}]{{0,16}}"  # marks on one character that a look behind passes over
WORD_CHAR = f"[[{LETTER}][{DIGIT}{KATAKANA}{ALONE}{CONNECTOR}{ATTACHED}]]"
RUNNING = f"[[{LETTER}][{DIGIT}]]"


def _between(before: str, joiner: str, after: str) -> str:
    return f"(?<=[{before}]{_A})[{joiner}](?={_A}[{after}])"


JOINER = "|".join([
    _between(LETTER, MID_LETTER + MID_BOTH, LETTER), _between(DIGIT, MID_DIGIT + MID_BOTH, DIGIT),
    _between(HEBREW, '"', HEBREW), f"(?<=[{HEBREW}]{_A})'"])
BOUNDARY = "|".join([
    f"(?!{JOINER})(?!{WORD_CHAR})(?s:.)",                       # a character that is of no word
    f"(?<=[{ALONE}]{_A})(?![{ATTACHED}])", f"(?=[{ALONE}])",     # on both sides of a word of its own
    f"(?<=[{KATAKANA}]{_A})(?={RUNNING})", f"(?<={RUNNING}{_A})(?=[{KATAKANA}])",
    f"(?<=[{HEBREW}]{_A}'{_A})(?![[{LETTER}][{ATTACHED}]])",      # behind a quote that a Hebrew letter keeps
    f"(?<=(?:^|(?!{WORD_CHAR})(?!{JOINER})(?s:.))[{ATTACHED}]{{1,16}})(?![{ATTACHED}])"])  # behind marks on no word
PLAIN = r"^[a-z0-9\x{DF}-\x{F6}\x{F8}-\x{FF}]+\z"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^`{|}~"  # of ASCII, without the connector _
IN_WORD = f"[[{LETTER}][{DIGIT}{KATAKANA}{ALONE}]]"


def _cut(lowered: Column) -> Column:
    return F.filter(F.split(lowered, BOUNDARY, -1), lambda word: word.rlike(IN_WORD))


def unicode_words(text: Column) -> Column:
    """array<string> of lower-cased words, in text order."""
    return _cut(F.lower(text))


def unicode_word_counts(rows: DataFrame, by: str, text: str) -> DataFrame:
    """(by, word, n): how often each word of ``unicode_words`` occurs.

    No rule looks past a space or line feed, so the texts are cut there first and each distinct
    piece is counted; the rules are applied once to each piece.  A piece of only Latin letters
    and digits between punctuation is one word without it, by any of the rules."""
    pieces = F.split(F.replace(F.lower(F.col(text)), F.lit("\n"), F.lit(" ")), " ", -1)
    counted = rows.select(by, F.explode(pieces).alias("piece")).where("piece <> ''").groupBy(by, "piece").agg(F.count("*").alias("n"))
    inner = F.btrim(F.col("piece"), F.lit(PUNCTUATION))
    words = F.when(inner.rlike(PLAIN), F.array(inner)).otherwise(_cut(F.col("piece")))
    return counted.select(by, F.explode(words).alias("word"), "n").groupBy(by, "word").agg(F.sum("n").alias("n"))


# The same rules as one pattern for RE2, for the oracle.
_RE2_LETTER = r"[\p{Latin}\p{Greek}\p{Cyrillic}\p{Hebrew}\p{Arabic}\p{Hangul}]\p{M}*"
ORACLE_WORD_PATTERN = (
    r"[\p{Han}\p{Hiragana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]\p{M}*|"
    r"\p{Pc}*(?:(?:(?:L)+(?:[:\x{B7}.'\x{2018}\x{2019}](?:L)+)*|\p{Nd}+(?:[,;.'\x{2018}\x{2019}]\p{Nd}+)*)+|[\p{Katakana}\x{30FC}]+)"
    r"(?:\p{Pc}+(?:(?:(?:L)+(?:[:\x{B7}.'\x{2018}\x{2019}](?:L)+)*|\p{Nd}+(?:[,;.'\x{2018}\x{2019}]\p{Nd}+)*)+|[\p{Katakana}\x{30FC}]+))*\p{Pc}*"
).replace("(?:L)", f"(?:{_RE2_LETTER})")
