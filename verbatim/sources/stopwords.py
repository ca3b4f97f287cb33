"""S5 — stop-word list.

The word list used for bigram cleaning is a small dimension (D11).  The default is
Spark's own English list (``StopWordsRemover.loadDefaultStopWords("english")``),
kept here as text so the DuckDB oracle can use the identical list; a test checks it
still equals Spark's.  Callers may pass any ``DataFrame(word)`` instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Spark's default English stop words, in Spark's order.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his "
    "himself she her hers herself it its itself they them their theirs themselves what "
    "which who whom this that these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of at by for "
    "with about against between into through during before after above below to from up "
    "down in out on off over under again further then once here there when where why how "
    "all any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd "
    "you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've "
    "you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't "
    "didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's "
    "how's let's ought that's there's what's when's where's who's why's would"
).split()

# A stop-word table is joined by broadcast; past this many rows a shuffle join is used.
MAX_BROADCAST_WORDS = 1_000_000


def stop_words(spark: SparkSession, words: DataFrame | list[str] | None = None) -> DataFrame:
    """``DataFrame(word string)`` of distinct, lower-case stop words."""
    if words is None:
        words = ENGLISH_STOP_WORDS
    if isinstance(words, DataFrame):
        return words.select(F.lower(F.col("word")).alias("word")).dropna().distinct()
    uniq = sorted({w.lower() for w in words})
    return spark.createDataFrame([(w,) for w in uniq], "word string")


def read_stop_words(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A stop-word table with a column ``word`` (other columns, e.g. lexicon, are ignored)."""
    return stop_words(spark, spark.read.format(fmt).load(path))
